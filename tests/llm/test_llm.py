"""Language-model operators on small inputs, against brute force where SQL can't say it."""

import collections
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("chatloom.llm.queries")

from chatloom.llm import conversations, language, leakage, mixture, pii, subjects  # noqa: E402

MESSAGES = "msg_row long, export_key string, message_id string, author_id string, ts string, content string, reply_to_message_id string, root string"


def frames(spark, rows):
    exports = spark.createDataFrame([("e", "UTC"), ("f", "Europe/Berlin")], "export_key string, tz_name string")
    return spark.createDataFrame(rows, MESSAGES), exports


def brute(rows):
    """Conversations by union-find; times are ISO and UTC here."""
    first, kept = {}, []
    for r in sorted(rows):
        i = (r[2] or "").strip()
        if i and (r[1], i) in first:
            continue
        if i:
            first[r[1], i] = r[0]
        kept.append(r)
    by = {r[0]: r for r in kept}
    parent, broken, link = {}, set(), {r[0]: r[0] for r in kept}

    def find(x):
        while link[x] != x:
            x = link[x]
        return x

    for r in kept:
        to = (r[6] or "").strip()
        if to:
            parent[r[0]] = first.get((r[1], to))
            if parent[r[0]] is None:
                broken.add(r[0])
            else:
                link[find(r[0])] = find(parent[r[0]])
    groups = collections.defaultdict(list)
    for x in by:
        groups[find(x)].append(x)
    out = set()
    for some in groups.values():
        roots = [x for x in some if x not in parent]
        authors = {by[x][3] for x in some}
        bad = any(x in broken or not by[x][3] or not (by[x][5] or "").strip() or not (by[x][4] or "").startswith("20") for x in some)
        if len(roots) == 1 and len(authors) > 1 and not bad:
            speakers = {}
            for turn, x in enumerate(sorted(some, key=lambda x: (by[x][4], x)), 1):
                out.add((roots[0], turn, x, speakers.setdefault(by[x][3], len(speakers) + 1)))
    return out


@pytest.mark.parametrize("hot", [10**9, 2])
def test_conversations(spark, hot):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        to = rng.choice([None, "", f"m{rng.randrange(max(1, k - 30), k + 2)}", f" m{rng.randrange(k + 1)} "]) if rng.random() < 0.9 else f"m{k + rng.randrange(5)}"
        rows.append((k, rng.choice("ef") if k % 10 == 0 else "e", rng.choice([f"m{k}", f"m{k} ", f"m{max(0, k - 1)}", None, ""]) if rng.random() < 0.2 else f"m{k}", rng.choice(["a", "b", "c"]) if rng.random() < 0.99 else rng.choice([None, ""]), f"2026-01-0{1 + k % 9}T00:00:0{rng.randrange(9)}Z" if rng.random() < 0.99 else "n/a", "x" if rng.random() < 0.99 else rng.choice([None, "​ "]), to, "clash"))
    rows += [(1000 + k, "f", f"d{k}", "ab"[k % 2], "2026-01-01T00:00:00Z", "deep", f"d{k - 1}" if k else None, "") for k in range(70)]  # a chain of depth 69
    rows += [(2000 + k, "f", f"c{k}", "ab"[k % 2], "2026-01-01T00:00:00Z", "cycle", f"c{(k + 1) % 3}", "") for k in range(3)] + [(2003, "f", "c9", "a", "2026-01-01T00:00:00Z", "tail", "c0", "")]
    rows = [r if not (r[5] and not r[5].strip("​ ")) else r[:5] + (" ",) + r[6:] for r in rows]
    messages, exports = frames(spark, rows)
    got = {tuple(r) for r in conversations.conversations(messages, exports, hot_rows=hot).select("conv_row", "turn", "msg_row", "speaker").collect()}
    assert got == brute(rows) and len([g for g in got if g[0] == 1000]) == 70
    assert not any(g[2] in (2000, 2003) for g in got)


def test_conversation_of_one_instant(spark):
    """100 000 messages of one conversation and one instant are ordered by several tasks."""
    n = 100_000
    rows = spark.range(n).select(
        F.col("id").alias("msg_row"), F.lit("e").alias("export_key"), F.concat(F.lit("m"), "id").alias("message_id"), F.concat(F.lit("a"), F.col("id") % 1000).alias("author_id"),
        F.lit("2026-01-01T00:00:00Z").alias("ts"), F.lit("x").alias("content"), F.when(F.col("id") > 0, "m0").alias("reply_to_message_id"),
    )
    exports = spark.createDataFrame([("e", "UTC")], "export_key string, tz_name string")
    got = conversations.conversations(rows, exports, hot_rows=1000)
    bad = got.where((F.col("turn") != F.col("msg_row") + 1) | (F.col("speaker") != F.col("msg_row") % 1000 + 1))
    assert got.count() == n and bad.count() == 0


def test_conversations_empty(spark):
    messages, exports = frames(spark, [])
    assert conversations.conversations(messages, exports).count() == 0


# --- language -----------------------------------------------------------------------------------


def test_viterbi_against_plain_search():
    rng = np.random.default_rng(5)
    lengths = np.array([1, 7, 3, 12])
    emissions = rng.normal(size=(23, 4)).astype(np.float32) * 3
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    got = language.viterbi(emissions, starts, lengths, 2.0)

    def value(path, e):
        return sum(float(e[t, s]) for t, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

    import itertools

    for s, n in zip(starts, lengths):
        e = emissions[s : s + n]
        if n <= 7:
            best = max(value(p, e) for p in itertools.product(range(4), repeat=int(n)))
            assert abs(value(got[s : s + n], e) - best) < 1e-4


def sample_rows():
    text = {
        "en": "Please read the pinned note about the build before you ask about the server again", "de": "Ich habe die gleiche Frage und noch keine Antwort auf das Problem bekommen",
        "fr": "Je ne suis pas sûr que le serveur soit vraiment le problème dans ce cas", "es": "Muchas gracias por la respuesta tan rápida, me ayudó bastante con el problema", "pt": "Muito obrigado pela resposta rápida, isso me ajudou bastante com o problema",
    }
    return text, [(k, v) for k, v in text.items()] * 4 + [("en", text["de"]), ("fr", text["es"])]


def test_language_spans_and_cases(spark):
    text, rows = sample_rows()
    model = language.fit(rows)
    ru, zh = "Большое спасибо за быстрый ответ, мне это очень помогло.", "我也有一样的疑问，到现在还没有人回答。"
    cases = [
        (1, "en", text["en"]), (2, "de", text["en"]), (3, None, text["fr"]), (4, "pt-BR", text["pt"]), (5, "EN", f"{text['en']}\n{text['es']}"), (6, "zh-Hans", zh), (7, "und", f"{ru} {zh}"), (8, "ru", None), (9, "nl", ""), (10, None, "ok +1"),
        (11, "de", f"```\n{text['en']}\n```\n[12:30] tin.dev: {text['de']}"), (12, "English", text["en"]), (13, "en", "https://x.y/a at line 3:4 v1.2"),
    ]
    df = spark.createDataFrame(cases, "id long, lang string, text string").withColumn("tbl", F.lit("clash"))
    got = {(r["row_no"], r["line_no"], r["lang"]) for r in language.mislabelled(df, "t", "id", "lang", "text", model).collect()}
    assert got == {(2, 0, "en"), (3, 0, "fr"), (5, 0, "en"), (5, 1, "es"), (7, 0, "ru"), (7, 0, "zh")}
    spans = language.spans(df, "t", "id", "lang", "text", model).where("row_no = 5").collect()
    assert all(0.5 < r["confidence"] <= 1 for r in spans)
    assert language.mislabelled(df.where("false"), "t", "id", "lang", "text", model).count() == 0
    long = spark.createDataFrame([(1, "de", text["en"] * 3000)], "id long, lang string, text string")
    assert language.mislabelled(long, "t", "id", "lang", "text", model).count() == 1


def test_language_without_training_uses_seeds():
    labeller = language.Labeller(language.fit([]))
    i, _, _, lang, size, _ = labeller.spans(["the house is not in the street and we have it", "das Haus ist nicht in der Straße und wir haben es"])
    assert [language.LANGUAGES[k] for k, s in zip(lang, size) if s >= 5] == ["en", "de"] and list(i)[-1] == 1


@pytest.mark.parametrize(("label", "want"), [("en-US", "en"), ("de_DE", "de"), ("PT", "pt"), ("unknown", None), ("", None), (None, None), ("nl", "nl"), (" Français ", "fr")])
def test_labels(label, want):
    assert language.label_of(label) == want


# --- personal information -----------------------------------------------------------------------

NAMES = pii.fit_names(
    [f"{g} {f}" for g in ("Ann", "Bob", "Eva") for f in ("Miller", "Stone-Hill", "Berg")] + ["Night Owl", "Captain Obvious", "the quiet one", "白墨川", "白雪舟", "林墨川", "林雪舟", "Лада Кедрих", "Лада Остроух", "Мирон Кедрих", "Мирон Остроух"]
)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("mail=ann-b@mail.x.example and", [("email", "ann-b@mail.x.example")]), ("git clone git@git.x.example:kit.git", []), ("ssh deploy@host.example -p 22", []), ("write ann (at) mail (dot) x (dot) test now", [("email", "ann (at) mail (dot) x (dot) test")]),
        ("pkg@3.5.586", []), ("My number is +1 257 555 0123, please", [("phone", "+1 257 555 0123")]), ("call 07700 900280 for", [("phone", "07700 900280")]), ("ticket #5551234567", []), ("order 2026-0470-7729", []), ("ping 10.0.28.7 -> 43ms", []),
        ("The form wants an ID and mine is 957 33 8811", [("id_number", "957 33 8811")]), ("build 454-22-2210 ok", []), ("IBAN DE89 3704 0044 0532 0130 00 ok", [("id_number", "DE89 3704 0044 0532 0130 00")]), ("IBAN DE88 3704 0044 0532 0130 00 ok", []),
        ("O meu documento é 529.982.247-25, certo", [("id_number", "529.982.247-25")]), ("Send it to Flat 7, 112 Fennel Close, Marrowby and", [("address", "Flat 7, 112 Fennel Close, Marrowby")]), ("an Am Alten Sudhaus 106, 66227 Quarzstadt schicken", [("address", "Am Alten Sudhaus 106, 66227 Quarzstadt")]),
        ("寄到 云溪市云杉大道102号1单元604室 ，谢谢", [("address", "云溪市云杉大道102号1单元604室")]), ("Dr. Ann Q. Miller here", [("person_name", "Ann Q. Miller")]), ("STONE-HILL, bob!", [("person_name", "STONE-HILL, bob")]), ("Night Owl and Ann said", []), ("Ann Miller, Bob Berg", [("person_name", "Ann Miller"), ("person_name", "Bob Berg")]),
        ("可以去问 白雪舟 ，", [("person_name", "白雪舟")]), ("знает Лада Остроух, там", [("person_name", "Лада Остроух")]), ("ann.miller@x.example", [("email", "ann.miller@x.example")]), ("", []), (None, []),
    ],
)
def test_pii(text, want):
    assert [(k, text[a:b]) for a, b, k in pii.find(text, NAMES)] == want


def test_checksums():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487") and pii.mod97_iban("GB82WEST12345698765432") and pii.mod23_dni("12345678Z") and pii.mod23_dni("X1234567L")
    assert pii.mod11_cpf("52998224725") and not pii.mod11_cpf("11111111111") and pii.mod11_2_resident("11010519491231002X")
    # the worked example of machine-readable documents: L898902C3 has check digit 6, 740812 has 2
    assert pii.weights_731("L898902C36") and not pii.weights_731("L898902C35") and pii.weights_731("7408122") and not pii.weights_731("7408123")
    assert not pii.mod97_iban("GB83WEST12345698765432") and not pii.mod23_dni("12345678A") and not pii.mod11_cpf("52998224726") and not pii.mod11_2_resident("110105194912310021")


def test_redaction_and_clashes(spark):
    df = spark.createDataFrame([(1, "call +1 257 555 0123 or ann@x.example", "Ann Miller", "kept"), (2, None, "", "k")], "msg_row long, content string, author_name string, field string")
    rows = pii.redacted(df, ("content", "author_name"), NAMES).orderBy("msg_row").collect()
    assert rows[0]["content"] == "call [PHONE] or [EMAIL]" and rows[0]["author_name"] == "[NAME]" and rows[0]["field"] == "kept" and rows[1]["content"] is None
    assert pii.items(df, "msg_row", ("content", "author_name"), NAMES).count() == 3
    assert pii.items(df.where("false"), "msg_row", ("content",), NAMES).count() == 0
    assert pii.find("x " * 20_000 + "ann@x.example", NAMES) == [(40_000, 40_013, "email")]
    assert pii.fit_lexicon([(df.where("false"), "author_name")], (df.where("false"), "content")).given == frozenset()


def test_lexicon_reads_all_rows_and_whole_texts(spark):
    """Names at the end of long texts, one pair in each of many rows; more display names than any sample."""
    pairs = [(g, f) for g in ("Ilva", "Oskur") for f in ("Brandel", "Tormund")]
    texts = [("so it goes " * 300 + f"ask {g} {f} about it",) for g, f in pairs] + [(f"line {k} of the log",) for k in range(120_000)]
    df = spark.createDataFrame(texts, "content string").repartition(4)
    shown = spark.range(60_000).select(F.concat(F.lit("nick"), F.col("id").cast("string")).alias("n"))
    names = pii.fit_lexicon([(shown, "n")], (df, "content"))
    assert names.given == {"ilva", "oskur"} and names.family == {"brandel", "tormund"}
    people = spark.createDataFrame([(f"{g} {f}",) for g, f in pairs], "n string")
    assert pii.fit_lexicon([(shown.unionByName(people), "n")]).given == {"ilva", "oskur"}
    # Words of neighbouring sentences without an end mark meet now and then, in many rows.
    noise = [f"{a} {b}" for a in ("Refrain", "Gruppe") for b in ("Vielen", "Kann")] + ["In der Gruppe", "Der Refrain", "Vielen dank", "Kann ich"] * 60
    assert pii.fit_names([], noise).given == frozenset()
    assert pii.fit_names([f"{g} {f}" for g, f in pairs], noise).given == {"ilva", "oskur"}


# --- leakage ------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [10, 10**6])
def test_leakage_brute_force(spark, block):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(6)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(2, 9)))) for k in range(25)] + [(99, None), (98, ""), (97, "w1 w1 w1 w1 w1")]
    docs = [(k, rng.choice([", ", "  ", "\n", "-"]).join(rng.choice([*words, "zz", "W1"]) for _ in range(rng.randrange(0, 40)))) for k in range(60)] + [(500, None), (501, items[3][1].upper()), (502, items[3][1])]
    corpus = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).repartition(3)
    grams = lambda t: {tuple(leakage.words_of(t)[i : i + 4]) for i in range(len(leakage.words_of(t)) - 3)}
    want = {(d, i) for d, t in docs for i, u in items if grams(t) & grams(u)}
    got = leakage.leaked(corpus, spark.createDataFrame(items, "item_id long, text string"), n=4, block_words=block).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    assert {r["doc_id"] for r in leakage.cleaned(corpus, spark.createDataFrame(items, "item_id long, text string"), n=4).collect()} == {d for d, _ in docs} - {d for d, _ in want}


@pytest.mark.parametrize("block", [10, 10**6])
def test_passages_are_cut_out(spark, block):
    item = "one two three four five six"
    docs = [(1, "Before, ONE two, three; four five six - after"), (2, item), (3, "one two three four x five six one two three four"), (4, "é\u0301 ü one two three four"), (5, None), (6, "nothing")]
    df = spark.createDataFrame([(*d, "kept") for d in docs], "doc_id long, text string, runs string")
    got = {r["doc_id"]: (r["text"], r["n_removed"], r["runs"]) for r in leakage.pruned(df, spark.createDataFrame([(7, item), (8, "two three four five")], "item_id long, text string"), n=4, block_words=block).collect()}
    assert got == {1: ("Before, - after", 6, "kept"), 2: ("", 6, "kept"), 3: ("x five six", 8, "kept"), 4: ("é\u0301 ü", 4, "kept"), 5: (None, 0, "kept"), 6: ("nothing", 0, "kept")}


def test_leakage_empty(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert leakage.leaked(docs, items).count() == 0 and leakage.leaked(docs.where("false"), spark.createDataFrame([(1, "a b c")], "item_id long, text string"), n=2).count() == 0


# --- mixture ------------------------------------------------------------------------------------


def test_mixture(spark):
    sized = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 6, "big").when(F.col("id") % 10 < 9, "mid").when(F.col("id") % 20 == 9, "small").otherwise(None).alias("source"), (F.col("id") % 7 + 5).alias("n_tokens"), F.lit(1).alias("copy"))
    targets = spark.createDataFrame([("big", 0.3, 2), ("mid", 0.5, 3), ("small", 0.2, 2), ("absent", 0.0, 1)], "source string, target_share double, max_repeats long")
    mixed = mixture.mix(sized, targets)
    counts = mixed.groupBy("doc_id").count().join(sized.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.max("count").alias("m")).collect()
    assert {r["source"]: r["m"] for r in counts} == {"big": 2, "mid": 3, "small": 2}
    shares = {r["source"]: r for r in mixture.reached(mixed, targets).collect()}
    total = sized.agg(F.sum("n_tokens")).first()[0]
    assert abs(shares["big"]["n_tokens"] / total - 0.3) < 0.01 and abs(shares["mid"]["n_tokens"] / total - 0.5) < 0.01 and shares["absent"]["n_rows"] == 0
    assert {r["source"] for r in mixture.plan(mixture.source_sizes(sized), targets).where("not reachable").collect()} == {"small"}
    assert {r["source"] for r in mixture.unreachable(sized, targets).collect()} == {"small"}
    assert {r["source"] for r in mixture.unreachable(sized.where("source <> 'mid'"), targets).collect()} >= {"mid"}
    assert sorted(map(tuple, mixed.select("doc_id", "copy_no").collect())) == sorted(map(tuple, mixture.mix(sized.repartition(5), targets).select("doc_id", "copy_no").collect()))
    assert mixture.mix(sized.where("false"), targets).count() == 0


def test_large_caps_cost_no_more(spark):
    sized = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "few").otherwise("many").alias("source"), F.lit(1).cast("long").alias("n_tokens"))
    took = {}
    for cap in (5, 500):
        targets = spark.createDataFrame([("few", 0.4, cap), ("many", 0.6, cap)], "source string, target_share double, max_repeats long")
        began = time.time()
        rows = {r["source"]: r["n_tokens"] for r in mixture.mix(sized, targets).groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")).collect()}
        took[cap] = time.time() - began
        assert rows["few"] == (500 if cap == 5 else rows["few"]) and abs(rows["many"] - 12_000) < 400
    assert abs(rows["few"] - 8_000) < 400 and took[500] < 3 * took[5] + 2


@pytest.mark.parametrize(("rate", "cap"), [(0.2, 1), (0.9, 1), (1.7, 2), (2.5, 4), (80.0, 500), (0.0, 3)])
def test_capped_mean(rate, cap):
    lam = mixture.capped_mean(rate, cap)
    draws = np.minimum(np.random.default_rng(7).poisson(lam, 200_000), cap)
    assert abs(draws.mean() - rate) < 0.01


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world\nagain"), (2, None), (3, ""), (4, "ü" * 5000)], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in df.select("doc_id", mixture.count_tokens(spark, F.col("text")).alias("n")).collect()}
    assert got[1] >= 4 and got[2] == 0 and got[3] == 0 and got[4] > 100


# --- subjects -----------------------------------------------------------------------------------


def test_subjects(spark):
    rng = random.Random(8)
    topics = {"sport": ["goalkeeper", "penalty", "marathon", "referee", "relay"], "music": ["violin", "chorus", "piano", "melody", "concert"], "law": ["statute", "tenancy", "plaintiff", "verdict", "licence"]}
    frames_ = ["I would not trust the {} until the {} has been checked twice.", "Without the {} there is no point in discussing the {} at all.", "The {} took longer than planned because of the {}."]
    chat = ["Thanks a lot for the quick answer, that was really helpful.", "Could a moderator please move this thread to the right channel?", "I will post a short summary of this thread tomorrow evening."]

    def sentence(t):
        return rng.choice(frames_).format(*rng.sample(topics[t], 2))

    docs, truth = [], {}
    for k in range(600):
        some = rng.sample(list(topics), rng.choice([0, 1, 1, 2]))
        lines = [sentence(t) for t in some for _ in range(rng.randrange(2, 5))] + [rng.choice(chat) for _ in range(rng.randrange(1, 5))]
        if other := [t for t in topics if t not in some]:
            lines += [sentence(other[0])] if rng.random() < 0.2 else []
        rng.shuffle(lines)
        docs.append((k, "\n".join(lines)))
        truth[k] = set(some)
    docs += [(1000, None), (1001, ""), (1002, "ok")]
    labels = [(k, s, "x") for k in range(0, 600, 6) for s in truth[k]] + [(3, "unknown", "x"), (9999, "law", "x"), (12, None, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("subject", F.lit("clash"))
    lab = spark.createDataFrame(labels, "doc_id long, subject string, labeller string")
    trained = subjects.train(df, lab, sorted(topics))
    model = trained.model
    rows = trained.areas().collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, subjects.areas(df, model).collect()))
    found = {(r["doc_id"], r["subject"]) for r in rows}
    want = {(k, s) for k, some in truth.items() for s in some}
    assert len(found & want) / len(want) > 0.97 and len(found & want) / max(1, len(found)) > 0.97
    assert all(0 <= r["posterior"] <= 1 for r in rows) and np.mean([r["posterior"] for r in rows]) > 0.7
    assert subjects.areas(df.where("false"), model).count() == 0
    empty = subjects.train(df.where("false"), lab, ["law"], rounds=1, own_rounds=1)
    assert empty.areas().count() == 0 and subjects.areas(df, empty.model).count() == 0
    unlabelled = subjects.train(df.limit(50), lab.where("false"), ["law"], rounds=1, own_rounds=1)
    assert unlabelled.areas().count() == 0


def test_votes_for_a_language_dont_carry():
    """256 words of one language aren't one of the next."""
    for n in (3, 255, 256, 257, 1000):
        _, _, tongues, _, _ = subjects.Features(frozenset()).parsed(["the " * n + "bridge"])
        assert tongues.tolist() == [subjects.LATIN.index("en")]


def test_starters_read_all_rows_and_whole_texts(spark):
    """A word that begins sentences in a few of many documents, or beyond a long text's start."""
    rows = [("so it goes. " * 400 + "Zudem works now.",)] * 6 + [("Quark ist gut.",)] * 6 + [(f"a note {k} on Quark.",) for k in range(4)] + [("plain words only",)] * 12_000
    df = spark.createDataFrame(rows, "text string").repartition(4)
    begin = subjects.starters(df)
    assert "Zudem" in begin and "Quark" not in begin
    assert subjects.starters(df.where("false")) == frozenset()
