"""Configuration, model commands, caches, results as inputs, reports and the command line over them."""

import gzip
import json
import sys

import pytest
from pyspark.sql import functions as F

from chatloom import config
from chatloom.operators import ai, caches, model, retrieval
from chatloom.sinks import dashboard, documents, reports
from chatloom.sources import results

MESSAGES = "ord long, message_id string, author_id string, author_name string, ts string, ts_text string, content string"


def chat(spark, rows):
    return spark.createDataFrame([(k, f"m{k}", f"a{k}", f"n{k}", None, f"t{k:03d}", text) for k, text in enumerate(rows)], MESSAGES)


def test_configuration_overrides_file_by_file(tmp_path, monkeypatch):
    assert len(config.fact_categories()) == 10 and config.retrieval_queries("zh") != config.retrieval_queries("en") == config.retrieval_queries("nowhere")
    (tmp_path / "queries.yaml").write_text("en: {q: text}\n")
    (tmp_path / "keywords.yaml").write_text("providers: {mine: [abc]}\n")
    (tmp_path / "domains.yaml").write_text("official: [mine.example]\nhf: [hub.example]\n")
    (tmp_path / "languages.yaml").write_text("xx: {ranges: [[65, 90]], threshold: 0.5}\n")
    (tmp_path / "regions.yaml").write_text("moon: {hours: {night: [22, 4]}, providers: [p]}\n")
    (tmp_path / "fact_schema.yaml").write_text("")
    monkeypatch.setenv(config.VARIABLE, str(tmp_path))
    assert config.retrieval_queries("de") == {"q": "text"} and config.keywords()["providers"] == {"mine": ("abc",)} and "friction" in config.keywords()
    assert config.domains().official == ("mine.example",) and dict(config.domains().by_host)["hf"] == ("hub.example",) and "messaging" in dict(config.domains().by_host)
    assert config.languages()["xx"].threshold == 0.5 and "zh" in config.languages() and config.regions()["moon"].hours == (("night", 22, 4),)
    assert config.fact_categories() == [] and config.brand_patterns()
    with pytest.raises(FileNotFoundError):
        config.load("nothing")
    prompt = config.extraction_prompt({"prompt_intro": "Intro", "prompt_rules": ["R1"], "categories": [{"field": "f", "fields": {"a": "x"}}]}, "German")
    assert '"f": [{"a": x}]' in prompt and "- R1" in prompt and "German" in prompt


def test_commands(tmp_path, monkeypatch):
    echo = f"{sys.executable} -c 'import sys; print(sys.argv[-1].upper())'"
    assert model.Command(echo)("hello") == "HELLO"
    assert model.Command(f"{sys.executable} -c 'import sys; print(sys.stdin.read()[::-1])'", stdin=True)("abc") == "cba"
    with pytest.raises(model.ModelError, match="ERROR"):
        model.Command(f"{sys.executable} -c 'import sys; sys.exit(3)'", retries=1, pause=0)("x")
    with pytest.raises(model.ModelError, match="TIMEOUT"):
        model.Command(f"{sys.executable} -c 'import time; time.sleep(9)'", timeout=0.2, retries=0)("x")
    once = tmp_path / "tried"
    flaky = f"{sys.executable} -c 'import pathlib, sys; p = pathlib.Path(\"{once}\"); there = p.exists(); p.touch(); sys.exit(0 if there else 1)'"
    assert model.Command(flaky, retries=1, pause=0)("x") == ""
    monkeypatch.delenv("LLM_COMMAND", raising=False)
    assert model.from_environment() is model.offline and model.offline("a\nb") == model.offline("a\nb")
    monkeypatch.setenv("LLM_COMMAND", echo)
    monkeypatch.setenv("LLM_MODEL_PRO", "big")
    assert model.from_environment(strong=True).model == "big" and model.from_environment(strong=True).timeout == 600


def _asked(log, answer):
    def ask(prompt):
        with open(log, "a") as f:
            f.write("x\n")
        return answer(prompt)

    return ask


def test_topics_by_model_and_cache(spark, tmp_path):
    log = tmp_path / "log"

    def answer(prompt):
        items = json.loads(prompt[prompt.rindex("\n[") + 1 :])
        if any("odd" in i["text"] for i in items) and len(items) > 1:
            return "no idea"
        if "odd" in items[0]["text"]:
            raise RuntimeError("down")
        return "```json\n" + json.dumps([{"id": i["id"], "topic": "bug_report" if "fail" in i["text"] else "made_up"} for i in items]) + "\n```"

    cache = caches.topic_cache(spark, str(tmp_path / "topics"))
    rows = chat(spark, ["it fails", "fine", "odd one", "it fails", None]).coalesce(1)
    got = {r["ord"]: r["topic"] for r in caches.tagged(rows, model.topic_tagger(_asked(log, answer)), cache).collect()}
    assert got == {0: "bug_report", 1: ai.FALLBACK, 2: ai.FALLBACK, 3: "bug_report", 4: ai.FALLBACK}
    asked = log.read_text().count("x")
    assert cache.read().count() == 3  # the failure isn't entered
    again = {r["ord"]: r["topic"] for r in caches.tagged(rows, model.topic_tagger(_asked(log, answer)), cache).collect()}
    assert again == got and log.read_text().count("x") - asked == 2  # the one text that failed, as a batch and alone


def test_fact_and_embedding_caches(spark, tmp_path):
    log = tmp_path / "log"
    rows = chat(spark, [f"line {k}" for k in range(250)])
    texts = ai.chunk_texts(ai.chunks(rows))

    def answer(prompt):
        if "line 150" in prompt and not (tmp_path / "up").exists():
            raise RuntimeError("down")
        return "{}" if "line 249" in prompt else json.dumps({"brand_confusion": [{"question": "q", "resolution": "answered", "tags": ["a", "b"]}]})

    cache = caches.FactCache(spark, str(tmp_path / "facts"))
    extractor = model.fact_extractor(_asked(log, answer))
    first = caches.facts(texts, config.fact_categories(), extractor, cache).collect()
    assert sorted((r["chunk_idx"], r["category"], bool(r["error"])) for r in first if r["category"] or r["error"]) == [(0, "brand_confusion", False), (1, None, True)]
    (tmp_path / "up").touch()
    second = caches.facts(texts, config.fact_categories(), extractor, cache)
    assert sorted(r["chunk_idx"] for r in second.where("category is not null").collect()) == [0, 1] and log.read_text().count("x") == 4
    assert {r["resolution"]: r["n"] for r in ai.resolutions(second).collect()} == {"answered": 2} and results.read_facts(spark, str(tmp_path / "facts")).count() == 3
    embedder = lambda texts: [[float(len(t or "")), 1.0] for t in texts]
    store = caches.embedding_cache(spark, str(tmp_path / "embeddings"))
    few = chat(spark, ["aa", "bbb", "aa", None])
    got = {r["ord"]: list(r["embedding"]) for r in caches.embedded(few, "content", store, "m", embedder).collect()}
    assert got == {0: [2.0, 1.0], 1: [3.0, 1.0], 2: [2.0, 1.0], 3: [0.0, 1.0]} and store.read().count() == 3
    caches.embedded(few, "content", store, "m", embedder).collect()
    assert store.read().count() == 3 and caches.embedded(few, "content", store, "other", embedder).count() == 4 and store.read().count() == 6


def test_amounts_and_products(spark):
    df = spark.createDataFrame([("用了 300 万 token, 20 元",), ("costs 3.5 $ and 7 rmb",), ("none",), (None,)], "t string")
    assert [r["a"] for r in df.select(ai.amounts(F.col("t")).alias("a")).collect()] == [["300", "20"], ["3.5", "7"], [], []]
    found = spark.createDataFrame([(0, "h", "pricing_complaints", {"service": "My PRODUCT x"}, None), (1, "h", "pricing_complaints", {"issue": "product"}, None), (2, "h", "other", {"service": "product"}, None), (3, "h", "pricing_complaints", None, None)], "chunk_idx long, hash string, category string, fact map<string,string>, error string")
    assert [r["chunk_idx"] for r in ai.about_product(found, "Product").collect()] == [0]


def test_reports(spark, tmp_path):
    rows = chat(spark, ["quillbase rocks", "QUILL BASE costs too much, 费用 300 万 token", "nothing", None])
    found = spark.createDataFrame([(0, "h", "brand_confusion", {"question": "which\nsite?", "resolution": "answered", "user_ref": "u"}, None), (1, "h", "brand_confusion", {"question": "q"}, None), (2, "h", "pricing_complaints", {"service": "quillbase", "issue": "dear", "user_ref": "v"}, None)], "chunk_idx long, hash string, category string, fact map<string,string>, error string")
    text = reports.brand_audit(rows, found, config.brand_patterns(), "Quillbase")
    assert "| `product` | 2 |" in text and "- answered: 1" in text and "- unknown: 1" in text and "which site?" in text and "**n0**" in text
    cost = reports.cost_report(rows, found, "QuillBase")
    assert "Complaints: 1; amounts named in them: 1" in cost and "**v** (quillbase): dear" in cost
    empty = reports.brand_audit(rows.where("false"), found.where("false"), {}, "x")
    assert "0 messages" in empty
    queries = [(0, "q", "quillbase price")]
    base = retrieval.embedded(retrieval.embeddable(rows), "content")
    asked = retrieval.embedded(spark.createDataFrame(queries, "query_id long, name string, text string"), "text")
    hits = retrieval.hits_with_messages(retrieval.top_k(base, asked, 2, base_id="ord"), rows)
    told = reports.findings(hits, queries, lambda p: f"seen {p.count('[')}")
    assert told["q"]["source_count"] == 2 and told["q"]["analysis"].startswith("seen") and "## q" in reports.findings_text(told, 3)

    def down(prompt):
        raise model.ModelError("TIMEOUT")

    assert reports.findings(hits, queries, down)["q"]["analysis"] == "[TIMEOUT]"
    narrative = "front\n## 1. Executive Summary\nshort\n\n## 2. Who\nthey\n\n## 3. What\nit\n"
    assert reports.split_report(narrative) == ("Executive Summary\nshort\n\n", "## 1. Who\nthey\n\n## 2. What\nit") and reports.split_report("") == ("", "")
    assert reports.cleaned_answer("---\n⚠️ warning\nThe file was saved\nkept\nreached maximum iterations\n") == "kept"
    prompt = reports.narrative_prompt({"metadata": {"total_messages": 4}}, told, {"f": 2}, [{"day": k, "joined": k} for k in range(12)], "3 members")
    assert "3 members" in prompt and '"joined": 11' in prompt and '"joined": 6' not in prompt and "14. Voices" in prompt
    final = reports.final_report(narrative, {"topics": {"counts": {"a": 1}}}, {"f": 2}, lambda p: "### A. x\nThe file y")
    assert "## Summary\n\nshort" in final and "## 2. What" in final and "### A. x" in final and "The file" not in final


def test_users_as_input(spark, tmp_path):
    entry = {"messaging": {"discord": 2}, "friction": {"error_generic": 1}, "impersonator_domains": {"a.b": 3}, "hours_of_day": {"9": 2, "20": 2, "3": 1}, "last_seen": "2026-06-20T00:00:00+00:00", "language_primary": "bilingual"}
    (tmp_path / "keyed.json").write_text(json.dumps({"u1": entry, "u2": {}, "u3": 5}))
    (tmp_path / "listed.json").write_text(json.dumps([{"user_id": "u1", **entry}, {"user_id": "u2"}]))
    (tmp_path / "lines.json").write_text(json.dumps({"author_id": "u1", "mentions": {"messaging:discord": 2, "friction:error_generic": 1}, "impersonator_messages": 3, "hours": {"9": 2, "20": 2}, "last_seen": "2026-06-20T00:00:00Z", "language_primary": "bilingual"}) + '\n{"author_id": "u2"}\nbroken{\n')
    for name in ("keyed", "listed", "lines"):
        rows = {r["author_id"]: r for r in results.read_users(spark, str(tmp_path / f"{name}.json")).collect()}
        assert set(rows) == {"u1", "u2"}, name
        one = rows["u1"]
        assert one["mentions"] == {"messaging:discord": 2, "friction:error_generic": 1} and one["impersonator_messages"] == 3 and one["hour"] == 9 and one["last_seen"].day == 20, name
        assert rows["u2"]["mentions"] == {} and rows["u2"]["language_primary"] == "silent" and rows["u2"]["hour"] is None


def test_users_of_large_files(spark, tmp_path):
    many = {f"u{k}": {"impersonator_messages": k, "hours": {"9": 1}, "pad": "x\u4e07" * 350} for k in range(15_000)}  # more than a VARIANT holds
    lines = [json.dumps({"author_id": k, **u}, ensure_ascii=False) for k, u in many.items()]
    texts = {
        "lines": "\n".join(lines), "broken_first": "\r\n".join(["broken{", *lines, "{"]), "keyed": json.dumps(many, ensure_ascii=False),
        "indented": json.dumps(many, ensure_ascii=False, indent=2), "listed": json.dumps([{"user_id": k, **u} for k, u in many.items()], ensure_ascii=False),
        "runs": json.dumps(many, ensure_ascii=False) + '\n{"last": {"impersonator_messages": 7}}\n',
    }
    for name, text in texts.items():
        assert len(text.encode()) > 16 << 20
        (tmp_path / f"{name}.json").write_text(text)
        rows = results.read_users(spark, str(tmp_path / f"{name}.json")).select("author_id", "impersonator_messages", "hour").collect()
        want = {(k, u["impersonator_messages"], 9) for k, u in many.items()} | ({("last", 7, None)} if name == "runs" else set())
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want, name
    (tmp_path / "off.json").write_text(texts["keyed"][:-9])
    with pytest.raises(Exception, match="broken or too large"):
        results.read_users(spark, str(tmp_path / "off.json")).collect()


def test_users_are_the_same_from_large_and_small_files(spark, tmp_path):
    user = {"mentions": {"messaging:discord": 2}, "hours": {"9": 2, "20": 2}, "last_seen": "2026-06-20T00:00:00Z", "pad": 'a "b" \\ \n {'}
    texts = {
        "keyed": json.dumps({"u1": user, 'u"2': {}, "u3": 5, "user_id": None}), "listed": json.dumps([{"user_id": "u1", **user}, {"author_id": "u2"}, {}, 5, [1]], indent=1), "single": json.dumps({"user_id": "u1", **user}, indent=1),
        "named": json.dumps({"author_id": 5, "u1": user}), "lines": "\n".join(json.dumps(x) for x in ({"author_id": "u1", **user}, {"user_id": "u2"}, {"u4": user}, [{"user_id": "u5"}], 5)) + "\n\nbroken{\n",
        "between": '[\n{"user_id": "u1"}\n,\n{"user_id": "u2"}\n]\n', "twice": '{"u1": {},\n"u1": {"hours": {}}}', "scalar": "5", "blank": " \n", "nothing": "", "no_users": "{}", "none": "[ ]",
    }
    (tmp_path / "all").mkdir()
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
        (tmp_path / f"{name}.json.gz").write_bytes(gzip.compress(text.encode()))
        (tmp_path / "all" / f"{name} {{1}} [2]%20.json").write_text(text)
    seen = lambda path, **more: sorted(map(str, results.read_users(spark, str(path), **more).collect()))
    for name in texts:
        small = seen(tmp_path / f"{name}.json")
        assert bool(small) == (name not in ("twice", "scalar", "blank", "nothing", "no_users", "none")), name
        assert small == seen(tmp_path / f"{name}.json", large=0) == seen(tmp_path / f"{name}.json.gz"), name
    assert len(seen(tmp_path / "all")) == 13 and seen(tmp_path / "all") == seen(tmp_path / "all", large=0) == seen(tmp_path / "all", large=200)
    (tmp_path / "empty").mkdir()
    assert seen(tmp_path / "empty") == []


def test_keyed_users_and_sections(spark, tmp_path):
    people = spark.createDataFrame([("b", "B", 1), ("a", 'A"', 2)], "author_id string, display_name string, message_count long")
    documents.write_users_keyed(people, tmp_path / "users.json", keep_names=True)
    assert {k: v["display_name"] for k, v in json.loads((tmp_path / "users.json").read_text()).items()} == {"a": 'A"', "b": "B"}
    with pytest.raises(ValueError):
        documents.write_users_keyed(people, tmp_path / "users.json", most=1)
    assert not reports.merge_section(tmp_path / "none.json", "x", 1)
    documents.write_json({"a": 1}, tmp_path / "s.json")
    assert reports.merge_section(tmp_path / "s.json", "topics", {"n": 2}) and json.loads((tmp_path / "s.json").read_text()) == {"a": 1, "topics": {"n": 2}}


def test_facts_with_too_many_fields_are_refused(spark, tmp_path):
    found = spark.createDataFrame([(0, "c", {f"k{k}": "v" for k in range(12)})], "chunk_idx long, category string, fact map<string,string>")
    with pytest.raises(ValueError, match="fields"):
        documents.write_facts(found, "c", str(tmp_path / "f"), most=11)
    assert len(documents.write_facts(found, "c", str(tmp_path / "f"), most=12)) == 12


def test_dashboard_parts():
    assert dashboard.terms((r"\bgo(lang)?\b", "won't compile", r"\bstack\s?overflow\b", r"\bc\+\+\b")) == ["golang", "go", "won't compile", "stack overflow", "stackoverflow", "c++"]
    now, before = {"metadata": {"total_messages": 12}, "users": {"total": 3}, "features": {"f": 2, "g": 1}}, {"metadata": {"total_messages": 10}, "users": {"total": 3}, "features": {"f": 1}}
    figures = {n: (v, d) for n, v, d in dashboard.kpis(now, before)}
    assert figures["Messages"] == (12, 2) and figures["Users"] == (3, 0) and figures["Answered"] == (None, None)
    text = dashboard.page(now, "T", [before], messages=[{"author_name": "<i>", "ts": None, "content": "</script><b>"}], keywords={"features": {"f": ("f",)}}, titles={"features": "Things"})
    assert "Things" in text and "</script><b>" not in text and "(+1)" in text and "polyline" in text and '"terms": {"f": ["f"]}' in text and 'id="word"' in text
    assert ("info", "Most named feature: f (2).") in dashboard.insights(now)


def test_cli_of_model_steps(spark, tmp_path, monkeypatch):
    import chatloom.session
    from chatloom import cli

    monkeypatch.setattr(chatloom.session, "local_session", lambda *a, **k: spark)
    monkeypatch.delenv("LLM_COMMAND", raising=False)
    messages = [{"platform": "x", "channel": "c", "message_id": str(k), "author_id": f"u{k % 3}", "author_name": f"n{k % 3}", "timestamp": f"2026-01-{1 + k:02d}T10:00:00Z", "content": "quillbase costs too much, 太贵" if k % 2 else "all fine here"} for k in range(10)]
    export, out = tmp_path / "e.json", tmp_path / "out"
    export.write_text(json.dumps({"messages": messages}))
    source = ["--input", str(export), "--platform", "canonical", "--salt-file", str(tmp_path / ".salt"), "--out", str(out)]
    assert cli.main(["analyze", *source]) == 0
    assert cli.main(["topics", *source]) == 0
    assert json.loads((out / "stats.json").read_text())["topics"] == {"total_tagged": 10, "counts": {ai.FALLBACK: 10}, "by_category": {ai.FALLBACK: 10}}
    assert results.read_topics(spark, str(out)).count() == 10 and (out / "topics_by_category" / f"topic={ai.FALLBACK}").is_dir()
    assert cli.main(["facts", *source]) == 0 and cli.main(["audit", *source, "--product", "Quillbase"]) == 0 and "| `product` | 5 |" in (out / "brand_audit.md").read_text()
    assert "Complaints: 5" in (out / "token_consumption.md").read_text()
    assert cli.main(["retrieve", *source, "--top", "2"]) == 0 and len(json.loads((out / "findings.json").read_text())) == 8
    assert cli.main(["engagement", *source[:-1], str(out / "stream_d"), "--humans", "9"]) == 0
    stickiness = json.loads((out / "stream_d" / "user_stickiness.json").read_text())
    assert stickiness["rates"]["posters"] == 3 and len(json.loads((out / "stream_d" / "temporal_growth.json").read_text())) == 10
    assert cli.main(["crosstabs", "--users-json", str(out / "users"), "--out", str(out)]) == 0 and "crosstabs" in json.loads((out / "stats.json").read_text())
    assert cli.main(["survey", "--out", str(out)]) == 0 and "## Recommendations" in (out / "final_report.md").read_text()
    assert cli.main(["dashboard", str(out / "stats.json"), "--chat", str(export), "--out", str(tmp_path / "d.html")]) == 0 and "quillbase costs" in (tmp_path / "d.html").read_text()
