"""Recall of the language and personal-data operators on texts written for this test, independent of the
tables: no sentence, phrase or item here was taken from them or looked at while the operators were made."""

import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

pytest.importorskip("chatloom.llm.queries")

from chatloom.llm import language, pii  # noqa: E402

TABLES = Path("/root/testdata/sf0.01")

SENTENCES = {
    "en": [
        "The old lighthouse keeper painted every window frame blue before winter arrived.", "My grandmother bakes rye bread whenever the neighbours come over for tea.",
        "Nobody expected the ferry to leave twenty minutes early on such a foggy morning.", "Please remember to water the tomatoes while we are away next weekend.",
        "A small dog followed the postman all the way up the hill.", "They sold their bicycles and bought a canoe together last spring.",
    ],
    "de": [
        "Der alte Leuchtturmwärter strich vor dem Winter alle Fensterrahmen blau an.", "Meine Großmutter backt Roggenbrot, wenn die Nachbarn zum Tee vorbeikommen.",
        "Niemand hatte erwartet, dass die Fähre an diesem nebligen Morgen so früh ablegt.", "Bitte vergiss nicht, am Wochenende die Tomaten im Garten zu gießen.",
        "Ein kleiner Hund lief dem Briefträger den ganzen Berg hinauf nach.", "Sie haben ihre Fahrräder verkauft und sich gemeinsam ein Kanu gekauft.",
    ],
    "fr": [
        "Le vieux gardien du phare a repeint toutes les fenêtres en bleu avant l'hiver.", "Ma grand-mère prépare du pain de seigle quand les voisins viennent prendre le thé.",
        "Personne ne pensait que le bateau partirait si tôt par un matin de brouillard.", "N'oublie pas d'arroser les tomates pendant que nous serons absents ce week-end.",
        "Un petit chien a suivi le facteur jusqu'en haut de la colline.", "Ils ont vendu leurs vélos et acheté ensemble un canoë au printemps dernier.",
    ],
    "es": [
        "El viejo farero pintó de azul todas las ventanas antes de que llegara el invierno.", "Mi abuela hornea pan de centeno cuando los vecinos vienen a tomar el té.",
        "Nadie esperaba que el barco saliera tan temprano en una mañana con tanta niebla.", "Por favor, acuérdate de regar los tomates mientras estamos fuera este fin de semana.",
        "Un perro pequeño siguió al cartero hasta lo más alto de la colina.", "Vendieron sus bicicletas y compraron juntos una canoa la primavera pasada.",
    ],
    "pt": [
        "O velho faroleiro pintou todas as janelas de azul antes da chegada do inverno.", "A minha avó assa pão de centeio quando os vizinhos vêm tomar chá.",
        "Ninguém esperava que o barco saísse tão cedo numa manhã com tanto nevoeiro.", "Por favor, não se esqueça de regar os tomates enquanto estivermos fora no fim de semana.",
        "Um cachorro pequeno seguiu o carteiro até o alto da colina.", "Eles venderam as suas bicicletas e compraram juntos uma canoa na primavera passada.",
    ],
    "ru": [
        "Старый смотритель маяка покрасил все оконные рамы в синий цвет до зимы.", "Моя бабушка печёт ржаной хлеб, когда соседи приходят пить чай.",
        "Никто не ожидал, что паром уйдёт так рано в туманное утро.", "Пожалуйста, не забудь полить помидоры, пока нас не будет дома.",
    ],
    "zh": ["老灯塔看守人在冬天来临之前把所有的窗框都漆成了蓝色。", "邻居们来喝茶的时候我奶奶总是会烤黑麦面包。", "谁也没想到渡轮会在这样一个大雾的早晨提前开走。", "周末我们不在家的时候请记得给番茄浇水。"],
}
FOREIGN = ["Старий доглядач маяка пофарбував усі віконні рами в синій колір до зими, і їхні діти раділи.", "古い灯台の番人は冬が来る前にすべての窓枠を青く塗りました。", "늙은 등대지기는 겨울이 오기 전에 모든 창틀을 파랗게 칠했다."]


@pytest.fixture(scope="module")
def model(spark):
    if not TABLES.exists():
        pytest.skip("needs labelled rows to learn from")
    read = lambda name: spark.read.parquet(f"{TABLES}/{name}.parquet")
    return language.fit_tables([(read("messages"), "msg_row", "lang", "content"), (read("documents"), "doc_id", "lang", "text")])


def cases(spark, model, rows):
    df = spark.createDataFrame([(k, None, t) for k, t in enumerate(rows)], "id long, lang string, text string")
    return {(r["row_no"], r["line_no"], r["lang"]) for r in language.mislabelled(df, "t", "id", "lang", "text", model).collect()}


def test_recall_of_lines(spark, model):
    rows = [(code, line) for code, lines in SENTENCES.items() for line in lines]
    got = cases(spark, model, [line for _, line in rows])
    for code in SENTENCES:
        want = {(k, 0, c) for k, (c, _) in enumerate(rows) if c == code}
        assert len(want & got) / len(want) >= 0.9, (code, want - got)
    assert len(got) <= 1.1 * len(rows)


def test_recall_of_switches_within_lines(spark, model):
    """Two languages in one line, every pair of them."""
    rows, want = [], set()
    for (a, some), (b, more) in itertools.permutations(SENTENCES.items(), 2):
        for x, y in zip(some[:3], more[1:4]):
            want |= {(len(rows), 0, a), (len(rows), 0, b)}
            rows.append(f"{x} {y}")
    got = cases(spark, model, rows)
    for code in SENTENCES:
        mine = {w for w in want if w[2] == code}
        assert len(mine & got) / len(mine) >= 0.9, (code, len(mine - got), len(mine))
    assert len(got - want) / len(got) < 0.1


def test_runs_between_runs_of_another_language(spark, model):
    """Six words, or eight Han characters without a blank, amid a line in another language."""
    rows, want = [], []
    for (a, some), (b, more) in itertools.permutations(SENTENCES.items(), 2):
        for x, y in zip(some[:3], more[1:4]):
            words = x.split()
            half = len(words) // 2
            if a != "zh" and half >= 5 and len(words) - half >= 5:
                middle = y[:10] if b == "zh" else " ".join(y.rstrip(".").split()[:6])
                rows.append(" ".join([*words[:half], middle, *words[half:]]))
                want.append({a, b})
    got = cases(spark, model, rows)
    found = [{c for k, _, c in got if k == i} for i in range(len(rows))]
    script = [w <= g for w, g in zip(want, found) if w & {"ru", "zh"}]
    latin = [w <= g for w, g in zip(want, found) if not w & {"ru", "zh"}]
    # Short runs between close languages, in words that no table holds, are the hard case: 34 of 60 are found.
    assert all(script) and sum(latin) / len(latin) >= 0.5, (sum(script), len(script), sum(latin), len(latin))
    assert not any(g - w for w, g in zip(want, found))


def test_addresses_spelt_out_are_no_text(spark, model):
    rows = [f"{SENTENCES['ru'][0]} anna.smith AT mail DOT gardenhouse DOT example", f"write to the_old_one (at) post (dot) village (dot) test. {SENTENCES['zh'][0]}"]
    assert cases(spark, model, rows) == {(0, 0, "ru"), (1, 0, "zh")}


def test_other_languages_are_none_of_the_seven(spark, model):
    df = spark.createDataFrame([(k, None, t) for k, t in enumerate(FOREIGN)], "id long, lang string, text string")
    rows = language.spans(df, "t", "id", "lang", "text", model).collect()
    assert {(r["row_no"], r["lang"]) for r in rows} == {(k, "other") for k in range(len(FOREIGN))} and cases(spark, model, FOREIGN) == set()


def test_whole_texts_teach_words(spark):
    """A word that stands beyond the 4000th character of its text is learnt."""
    filler = "und der Hund ist nicht hier " * 200
    rows = [(k, "de", filler + f"\nder Quarzgang und die Moorbirke sind nicht neu {k}") for k in range(5)]
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    assert "quarzgang" in language.fit_tables([(df, "id", "lang", "text")]).words


# --- personal data ------------------------------------------------------------------------------

GIVEN = ["Maribel", "Thorsten", "Aurelie", "Casimir", "Philippa", "Ignacio", "Ludmila", "Benedikt"]
FAMILY = ["Okonkwo", "Vandersloot", "Petrenko", "Lindqvist", "Abernathy", "Castelnuovo", "Hargreaves", "Zielinski"]
ITEMS = {
    "email": ["m.okonkwo@postfach.example", "casimir_77@mail.uni-old.example", "hello+shop@kiosk.example", "philippa(at)garden(dot)example"],
    "phone": ["+44 20 7946 0018", "+49 30 901820", "+33 6 12 34 56 78", "(415) 555-0134", "555-0134", "06 12 34 56 78", "+7 495 123-45-67", "138 0013 8000"],
    "id_number": ["123-45-6789", "QQ 12 34 56 C", "12345678Z", "529.982.247-25", "11010519491231002X", "1 84 12 76 451 089 46", "DE89 3704 0044 0532 0130 00", "4111 1111 1111 1111", "X1234567"],
    "address": ["221B Baker Street", "14 Mill Lane, Ashford", "Lindenweg 7, 50667 Köln", "12 rue des Lilas, 69003 Lyon", "Calle Mayor 15, 28013 Madrid", "Rua das Flores, 120, Porto", "ул. Ленина, д. 5, кв. 12", "北京市海淀区中关村路12号3单元401室"],
    "person_name": [f"{g} {f}" for g, f in zip(GIVEN, FAMILY[3:] + FAMILY[:3])] + [f"{f}, {g}" for g, f in zip(GIVEN[:3], FAMILY[5:])],
}
PHRASES = {
    "email": ["Could you forward the minutes to {}, thanks?", "Her new mailbox is {} since Monday.", "If that bounces try {} instead."],
    "phone": ["You can ring {} after six.", "Best to call {} in the morning.", "The doctor's phone is {} now."],
    "id_number": ["The clerk asked for my identity number, which is {}.", "On the form the tax id was written as {}.", "My passport or card says {}, as far as I can read it."],
    "address": ["The parcel goes to {}", "We moved to {}", "Since May she lives at {}"],
    "person_name": ["Yesterday {} brought the keys back.", "ask for {} at the desk", "The talk by {} was moved."],
}
HARMLESS = [
    "The build 4111111111111111 finished in 12 minutes.", "Version 1.2.3.4 was released on 2024-05-06 at 10:30.", "Ticket 555-0134-22 is closed, order 12345678 shipped.", "We need 12 chairs and 30 cups for the hall.",
    "git clone git@host.example:team/repo.git", "The error code was 0x80070057 on line 1234567.", "Meet at the corner of the market at 18:30.", "It costs 1,250.00 or 2 400 for both.",
]


def test_recall_of_personal_data():
    shown = [f"{g} {f}" for g in GIVEN for f in FAMILY if (GIVEN.index(g) + FAMILY.index(f)) % 3 == 0]
    names = pii.fit_names(shown)
    for kind, items in ITEMS.items():
        pairs = [(item, phrase) for item in items for phrase in PHRASES[kind]]
        found = 0
        for item, phrase in pairs:
            text = phrase.format(item)
            start = text.index(item)
            found += any(a == start and k == kind for a, _, k in pii.find(text, names))
        assert found / len(pairs) >= 0.9, (kind, found, len(pairs), [p for p in pairs if not any(k == kind for _, _, k in pii.find(p[1].format(p[0]), names))][:8])
    assert [pii.find(t, names) for t in HARMLESS] == [[]] * len(HARMLESS)
