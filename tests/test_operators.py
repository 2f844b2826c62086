"""Operators on small inputs with nulls, ties, repeats, blanks, clashing columns and empty tables."""

import datetime as dt
import json
import random
from zoneinfo import ZoneInfo

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.functions import ids, lexicon
from chatloom.functions import text as T
from chatloom.functions.instants import parse_batch
from chatloom.operators import ai, crosstabs, dedup, engagement, incremental, nested, profiles, ranges, retrieval, skew, statistics
from chatloom.plans.lineage import Cuts

# --- text layer ---------------------------------------------------------------------------------


def column(spark, values, f):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string")
    return [r["x"] for r in df.select("k", f(F.col("t")).alias("x")).orderBy("k").collect()]


def test_language_class(spark):
    zh, es, de = lexicon.LANGUAGES["zh"], lexicon.LANGUAGES["es"], lexicon.LANGUAGES["de"]
    assert column(spark, ["I am using 这个工具 for my project", "   ", None, "hello world", "你好世界", "hi", "\xa0\xa0"], lambda c: T.language_class(c, zh)) == ["mixed", "unknown", "unknown", "other", "target", "unknown", "unknown"]
    assert column(spark, ["hello world", "  "], lambda c: T.language_class(c, None)) == ["target", "unknown"]
    assert column(spark, ["que de la en el y"], lambda c: T.language_class(c, es)) == ["target"]
    assert column(spark, ["Der Fehler ist nicht in der Datei, sondern im Netz", "x" * 100_000], lambda c: T.language_class(c, de)) == ["mixed", "other"]


def test_keywords(spark):
    hits = lambda words: lambda c: T.any_keyword(c, words)
    assert column(spark, ["openaicom", "OpenAI!", "openai", "xopenai", "éopenai", "a_openai"], hits(["openai"])) == [False, True, True, False, False, False]
    assert column(spark, ["我想接入飞书机器人"], hits(["飞书"])) == [True]
    assert column(spark, ["C++ to Rust", "c++x", "cpp"], hits([r"\bc\+\+\b", r"\bcpp\b"])) == [False, True, True]
    assert column(spark, ["see r/rust", "r/rusty"], hits(["r/rust"])) == [True, False]


def test_questions_and_urls(spark):
    assert column(spark, ["ok?", "Ok? \n", "how so", "show it", "怎么办", "was ist das", None], lambda c: T.is_question(c, None)) == [True, True, True, False, False, False, False]
    assert column(spark, ["怎么办"], lambda c: T.is_question(c, "zh")) == [True]
    assert column(spark, ["was ist das"], lambda c: T.is_question(c, "de")) == [True]
    assert column(spark, ["(https://a.b/c) HTTP://X.y, z", None], T.urls) == [["https://a.b/c", "HTTP://X.y"], []]
    urls = ["https://rust-lang.org/docs", "https://rust-lang.com/fake", "https://api.deepseek.com/v1", "https://open.feishu.cn/bot", "https://online.media/x", "https://u@host:80?q"]
    assert column(spark, urls, T.url_category) == ["official", "impersonator", "regional_vendor", "messaging", "messaging", "other"]
    assert column(spark, urls[-1:], T.host) == ["u@host:80?q"]


def test_hours_and_cohorts(spark):
    region = lexicon.RegionProfile("x", (("night", 22, 3), ("three", 3, 5)))
    df = spark.range(24).select(F.col("id"), T.hour_bucket(F.col("id"), region).alias("b"))
    by = {r["id"]: r["b"] for r in df.collect()}
    assert [by[h] for h in (21, 22, 0, 3, 4, 6)] == ["other", "night", "night", "night", "three", "other"]
    rows = spark.createDataFrame([(3, 4, 3), (7, 0, 3), (0, 0, 0), (0, 2, 8)], "t long, m long, o long")
    assert [r[0] for r in rows.select(T.language_primary(F.col("t"), F.col("m"), F.col("o"))).collect()] == ["bilingual", "target_primary", "silent", "other_primary"]
    now = F.lit("2026-07-01").cast("timestamp")
    seen = spark.createDataFrame([("2026-06-20",), ("2026-06-01",), ("2026-05-01",), ("2026-01-01",), (None,)], "s string")
    assert [r[0] for r in seen.select(T.retention_class(F.col("s").cast("timestamp"), now)).collect()] == ["active_30d", "active_30d", "lapsed_30_90d", "lapsed_90d_plus", "unknown"]


def test_ids(spark):
    assert column(spark, [" a ", "​", None, "", "\xa0x　"], ids.clean_id) == ["a", None, None, None, "x"]
    assert column(spark, ["a", " \t\n", "​", None, "", "\U0001f600", "ㅤ"], ids.is_blank) == [False, True, True, True, True, False, True]
    assert column(spark, ["", None, "u"], lambda c: ids.hash_stream_user(c, "s"))[:2] == ["unknown", "unknown"]


# --- instants -----------------------------------------------------------------------------------


def instant(value, zone="Europe/Berlin"):
    us = parse_batch(pa.array([value], pa.string()), pa.array([zone], pa.string())).to_pylist()[0]
    return None if us is None else dt.datetime.fromtimestamp(us / 1e6, dt.timezone.utc).isoformat()


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("2024-01-01T05:18:01+00:00", "2024-01-01T05:18:01+00:00"), ("2024-10-27 02:30:00", "2024-10-27T00:30:00+00:00"), ("2024-03-31 03:05:57 CEST", "2024-03-31T01:05:57+00:00"),
        ("Apr 10, 2026 12:41 AM", "2026-04-09T22:41:00+00:00"), ("Fri, 01 Aug 2025 19:11:33 +1000", "2025-08-01T09:11:33+00:00"), ("1704117336.5", "2024-01-01T13:55:36.500000+00:00"),
        ("1704117336123", "2024-01-01T13:55:36.123000+00:00"), ("20240101T214012Z", "2024-01-01T21:40:12+00:00"), ("2024-01-05T02:56:08[Asia/Kolkata]", "2024-01-04T21:26:08+00:00"),
        ("  01.01.2024 04:51:09 ", "2024-01-01T03:51:09+00:00"), ("2024-01-01 00:03:05 EST", "2024-01-01T05:03:05+00:00"), ("2024-01-01T07:36:45.0118849Z", "2024-01-01T07:36:45.011884+00:00"),
        (None, None), ("", None), ("2025-06-", None), ("2025-13-41T09:00:00Z", None), ("0000-00-00 00:00:00", None), ("yesterday 14:05", None), ("2024-02-30 10:00", None), ("2024-01-01", None),
        ("Tue Mar 05 2024 10:00:00 GMT+0100 (Central European Standard Time)", "2024-03-05T09:00:00+00:00"), ("Tue Mar 05 2024 10:00:00 XYZ+0100", None),
        ("Tue, 05 Mar 2024 10:00:00 +0100 (Central European Standard Time, as the sender's own machine is set to it)", "2024-03-05T09:00:00+00:00"),
        ("2024-03-05" + " " * 300 + "10:00:00Z", "2024-03-05T10:00:00+00:00"), ("Tue Mar 05 2024 10:00:00 UTC-0200 (" + "y" * 3000 + ")", "2024-03-05T12:00:00+00:00"), ("x" * 100_000, None),
        ("2024-01-01 25:00", None), ("9" * 500, None), ("２０２４-01-01 00:00", None), ("Apr 10, 2026 13:41 PM", None), ("2024-01-01 10:00 XYZ", None),
    ],
)
def test_instants(value, want):
    assert instant(value) == want


def test_another_zone_release_is_refused(spark):
    from chatloom.functions import instants

    df = spark.createDataFrame([("2024-01-01 10:00", "UTC")], "v string, z string")
    with pytest.raises(Exception, match="release"):
        df.select(instants.to_utc_us("v", "z", "1999a")).collect()
    assert df.select(instants.to_utc_us("v", "z", instants.tz_release())).first()[0] == 1704103200000000


def test_instant_needs_a_zone():
    assert instant("2024-01-01 10:00", None) is None and instant("2024-01-01 10:00", "No/Where") is None and instant("2024-01-01 10:00Z", None) is not None


@settings(max_examples=200, deadline=None)
@given(st.datetimes(dt.datetime(1972, 1, 1), dt.datetime(2037, 1, 1)), st.sampled_from(["Europe/London", "America/Sao_Paulo", "Australia/Sydney", "Asia/Kolkata", "America/New_York", "UTC"]))
def test_instants_against_zoneinfo(naive, zone):
    want = naive.replace(tzinfo=ZoneInfo(zone), fold=0).astimezone(dt.timezone.utc)
    us = parse_batch(pa.array([naive.isoformat(sep=" ", timespec="microseconds")]), pa.array([zone])).to_pylist()[0]
    assert us == (want - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


# --- skew, duplicates, nesting ------------------------------------------------------------------


def test_heavy_hitters(spark):
    rng = random.Random(1)
    keys = ["hot"] * 3000 + ["warm"] * 200 + [None] * 500 + [f"k{rng.randrange(4000)}" for _ in range(6300)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(k, i, "x") for i, k in enumerate(keys)], "author string, v long, _k string").repartition(7)
    assert sorted(map(tuple, skew.heavy_hitters(df, "author", 0.02).collect())) == [("hot", 3000), ("warm", 200)]
    got = {r["author"]: (r["n"], r["s"]) for r in skew.aggregate_by_key(df, "author", [F.count("*").alias("n"), F.sum("v").alias("s")], [F.sum("n").alias("n"), F.sum("s").alias("s")], share=0.01).collect()}
    want = {r["author"]: (r["n"], r["s"]) for r in df.groupBy("author").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert got == want
    assert skew.heavy_hitters(df.where("false"), "author", 0.02).count() == 0
    assert skew.aggregate_by_key(df.where("false"), "author", [F.count("*").alias("n")], [F.sum("n").alias("n")]).count() == 0


def test_duplicates_brute_force(spark):
    rng = random.Random(2)
    pool = ["a", "b ", " b", "", None, " ", "x" * 40, "x" * 40 + " ", "é" * 13, "123"]
    exports = ["00112233445566aa", "ffeeddccbbaa0099", "other", None]
    m = [(i, rng.choice(exports), rng.choice(pool), "t") for i in range(300)]
    s = [(i, rng.choice(exports), rng.choice(pool[:4] + pool[8:])) for i in range(12)]
    messages = spark.createDataFrame(m, "msg_row long, export_key string, message_id string, q string")
    seen = spark.createDataFrame(s, "seen_no long, export_key string, message_id string")
    key = lambda e, i: (e or "", (i or "").strip())
    known, want, first = {key(e, i) for _, e, i in s}, set(), set()
    for r, e, i, _ in m:
        if key(e, i)[1]:
            if key(e, i) in known or key(e, i) in first:
                want.add(("messages", r))
            first.add(key(e, i))
    first = set()
    for r, e, i in s:
        if key(e, i)[1]:
            if key(e, i) in first:
                want.add(("seen_messages", r))
            first.add(key(e, i))
    assert set(map(tuple, dedup.duplicate_rows(messages, seen).collect())) == want
    kept = {r["msg_row"] for r in dedup.first_copies(messages, seen).collect()}
    assert kept == {r[0] for r in m} - {r for t, r in want if t == "messages"}
    assert dedup.duplicate_rows(messages.where("false"), seen.where("false")).count() == 0


def test_shred_links_and_round_trip(spark):
    docs = [
        (1, json.dumps({"a": {"b": 1, "c": {"d": "x"}}, "items": [{"n": 1, "tags": ["p", "q"], "kids": [{"n": 2}, {"n": 3}]}, {"n": None}], "path": "z"})), (2, json.dumps({"items": []})), (3, "[{\"n\": 9}]"),
        (4, "broken{"), (5, None), (6, "{\"items\": 5}"), (7, "{} x"), (8, ""),
    ]
    df = spark.createDataFrame(docs, "id long, j string")
    tables = nested.shred(df, "id", "j", names={(): "items"})
    assert set(tables) == {"record", "items", "tags", "kids"}
    record = {r["id"]: r.asDict() for r in tables["record"].collect()}
    assert set(record) == {1, 2, 6} and record[1]["a.b"] == "1" and record[1]["a.c.d"] == "x" and record[1]["path_"] == "z"
    items = {(r["id"], tuple(r["keys"])): r["n"] for r in tables["items"].collect()}
    assert items == {(1, (0,)): "1", (1, (1,)): None, (3, (0,)): "9"}
    for child in ("tags", "kids"):
        for r in tables[child].collect():
            assert (r["id"], tuple(r["parent_keys"])) in items and r["parent_path"] == "$.items[]"
    assert sorted(r["$"] for r in tables["tags"].collect()) == ["p", "q"]
    assert nested.shred(df.where("false"), "id", "j") == {}


def test_same_rows_however_large(spark):
    """Texts read as VARIANT and texts taken apart element by element give the same tables."""
    docs = [
        {"a": {"b": 1.50, "c": True}, "items": [{"n": 1e3, "who": {"id": 5}, "tags": ["p", {"x": "ü"}], "kids": [{"n": 2, "kids": [{"n": "d.e"}]}]}, {"n": None}, 7, [1, [2]]], "meta": {"who": {"id": "w"}}},
        [{"n": 9, "N": 10, "tags": []}, "s"], {"items": {"n": 1}}, 5, None, {"data": {"items": [{"n": 1, "odd.key": "k", "it's": 2, "it's \"odd\"?": 3, "what.'\"?": {"a": 4}}]}, "who": {"id": 3}},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(90, "[1,"), (91, "{} {}"), (92, None)], "id long, j string")
    inherit = {"tags": ["n", "who.id"], "items": ["a.b"]}
    read = [nested.shred(df, "id", "j", names={(): "items"}, inherit=inherit, large=large) for large in (nested.LARGE, 0)]
    assert set(read[0]) == set(read[1]) and "who" in read[0]
    for name in read[0]:
        rows = [sorted(map(str, t[name].collect())) for t in read]
        assert rows[0] == rows[1] and rows[0], name
    assert {(r["id"], r["parent.n"]) for r in read[0]["tags"].collect()} == {(0, "1000")}


@pytest.mark.parametrize("mib", [20, 140])
def test_large_payloads_are_whole(spark, mib):
    message = {"message_id": "m", "author_id": "a", "content": "x" * 10_000, "reactions": [{"emoji": "y", "count": 1}]}
    n = mib * (1 << 20) // 10_100
    payload = '{"messages": [' + ",".join(json.dumps(message) for _ in range(n)) + ', {"message_id": "last", "reactions": [{"emoji": {"name": "z"}}]}]}'
    tables = nested.chat_tables(spark.createDataFrame([(1, payload), (2, '{"messages": [{"id": 5}]}')], "record_id long, payload string"))
    assert nested.message_table(tables).count() == n + 2
    assert [r["message_pos"] for r in nested.reaction_table(tables).where("emoji = 'z'").collect()] == [n]


def test_too_large_for_one_value_is_refused(spark):
    df = spark.createDataFrame([('["' + "x" * (20 << 20) + '"]',)], "v string")
    with pytest.raises(Exception, match="too large for a VARIANT"):
        df.select(nested.whole_json(F.col("v")).cast("string")).collect()


def test_recursive_and_shared_elements_have_tables():
    found = [((), "object"), (("replies",), "array"), (("replies", "[]"), "object"), (("replies", "[]", "n"), "scalar"), (("replies", "[]", "replies"), "array"), (("replies", "[]", "replies", "[]"), "object"), (("replies", "[]", "replies", "[]", "n"), "scalar"), (("odd`: name",), "scalar")]
    tables = nested.inline(nested.build_graph(found))
    assert tables["replies"].recursive and len(tables["replies"].places) == 2 and "odd`: name" in tables["record"].places[0].cells
    shared = [((), "object"), (("a",), "object"), (("b",), "object"), (("a", "p"), "object"), (("b", "p"), "object"), (("a", "p", "n"), "scalar"), (("b", "p", "n"), "scalar"), (("a", "own"), "object"), (("a", "own", "n"), "scalar")]
    tables = nested.inline(nested.build_graph(shared))
    assert set(tables) == {"record", "p"} and set(tables["record"].places[0].cells) == {"a.own.n"} and {p.parent for p in tables["p"].places} == {()}


def test_reactions_of_all_shapes(spark):
    payloads = [
        json.dumps([{"type": "message", "ts": "1.5", "user": "U", "reactions": [{"name": "joy", "users": ["a", "b"]}, {"name": "up", "count": "4"}]}]), json.dumps({"data": {"items": [{"message_id": "om", "sender": {"id": "z"}, "reactions": [{"reaction_type": {"emoji_type": "OK"}, "operators": [{}]}]}]}}),
        json.dumps({"messages": [{"id": 7, "author": {"id": 5}, "reactions": [{"emoji": {"name": "x"}, "count": None}, {"emoji": "y"}]}, {"id": 8, "reactions": None}, {"id": 9, "reactions": {}}, 3]}), "[", "null", None,
    ]
    df = spark.createDataFrame(list(enumerate(payloads)), "record_id long, payload string")
    tables = nested.chat_tables(df)
    rows = nested.reaction_table(tables).orderBy("record_id", "message_pos", "reaction_pos").collect()
    assert [(r["record_id"], r["message_pos"], r["reaction_pos"], r["message_id"], r["author_key"], r["emoji"], r["n"]) for r in rows] == [
        (0, 0, 0, "1.5", "U", "joy", 2), (0, 0, 1, "1.5", "U", "up", 4), (1, 0, 0, "om", "z", "OK", 1), (2, 0, 0, "7", "5", "x", None), (2, 0, 1, "7", "5", "y", None),
    ]
    assert sorted((r["record_id"], r["message_pos"], r["message_id"]) for r in nested.message_table(tables).collect()) == [(0, 0, "1.5"), (1, 0, "om"), (2, 0, "7"), (2, 1, "8"), (2, 2, "9")]
    empty = nested.chat_tables(df.where("false"))
    assert nested.reaction_table(empty).count() == nested.message_table(empty).count() == 0
    elsewhere = nested.chat_tables(spark.createDataFrame([(1, '{"export": {"rows": [{"id": 1, "reactions": [{"name": "n"}]}]}}')], "record_id long, payload string"))
    assert [(r["message_id"], r["emoji"]) for r in nested.reaction_table(elsewhere).collect()] == [("1", "n")]


# --- analytics ----------------------------------------------------------------------------------

SCHEMA = "ord long, platform string, channel string, message_id string, author_id string, author_name string, ts timestamp, content string, reply_to_message_id string, attachment_count int"


def messages(spark, rows):
    base = {"platform": "p", "channel": "c", "message_id": None, "author_id": None, "author_name": None, "ts": None, "content": None, "reply_to_message_id": None, "attachment_count": 0}
    made = [{**base, "ord": k, **r} for k, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in made], SCHEMA)


def at(day, hour=0, minute=0, us=0):
    return dt.datetime(2026, 1, day, hour, minute, 0, us)


def test_answered_window(spark):
    rows = [
        {"message_id": "q1", "ts": at(1), "content": "why?"}, {"reply_to_message_id": "q1", "ts": at(3)}, {"message_id": "q2", "ts": at(1), "content": "why?"}, {"reply_to_message_id": "q2", "ts": at(3, us=1)},
        {"message_id": "q3", "ts": at(5), "content": "why?", "author_id": "a"}, {"reply_to_message_id": "q3", "ts": at(4), "author_id": "a"}, {"message_id": "q1", "ts": at(9), "content": "again?"}, {"message_id": "", "ts": at(1), "content": "no id?"},
    ]
    rich = profiles.enriched(messages(spark, rows), None)
    assert sorted(r["ord"] for r in profiles.answered_questions(rich).collect()) == [0, 4, 6]
    one = profiles.question_summary(rich).first()
    assert (one["questions"], one["answered"]) == (5, 3)
    assert profiles.question_summary(rich.where("false")).first()["rate"] is None


def test_profiles_ties_and_nulls(spark):
    rows = [{"author_id": "a", "author_name": "First", "ts": at(1, 9)}, {"author_id": "a", "author_name": "Second", "ts": at(1, 5)}, {"author_id": None, "ts": None, "content": "cargo https://crates.io"}]
    rich = profiles.enriched(messages(spark, rows), None)
    got = {r["author_id"]: r for r in profiles.user_profiles(rich).collect()}
    assert got["a"]["display_name"] == "First" and got["a"]["hours"] == {5: 1, 9: 1} and got["a"]["language_primary"] == "silent" and got["a"]["mentions"] is None
    assert got[""]["mentions"] == {"providers:cargo": 1} and got[""]["hours"] is None and got[""]["urls_posted"] == 1
    assert {r["author_id"]: r["hour"] for r in profiles.modal_hours(rich).collect()} == {"a": 9}
    assert {a: r["hour"] for a, r in got.items() if r["hour"] is not None} == {"a": 9}
    assert profiles.user_profiles(rich.where("false")).count() == 0
    assert statistics.statistics(rich.where("false"), profiles.user_profiles(rich.where("false"))).where("value > 0").count() == 0


def test_double_count_of_impersonators(spark):
    rich = profiles.enriched(messages(spark, [{"content": "http://rust-lang.com/x and rust-download.com"}]), None)
    assert {(r["domain"], r["n"]) for r in profiles.domain_hits(rich).collect()} == {("rust-lang.com", 2), ("rust-download.com", 1)}


def test_pivot_multi_row_and_totals(spark):
    rows = spark.createDataFrame([(["a", "b"], "x"), ([], "y"), (["a"], "x")], "r array<string>, c string")
    cells = crosstabs.pivot(rows, "r", "c")
    assert {(r["row_label"], r["col_label"], r["n"]) for r in cells.collect()} == {("a", "x", 2), ("b", "x", 1), ("(none)", "y", 1)}
    totals = {(r["row_label"], r["col_label"]): r for r in crosstabs.with_totals(cells).collect()}
    assert totals["(all)", "(all)"]["n"] == 4 and totals["(all)", "x"]["row_pct"] == 75 and totals["a", "x"]["small"]


def test_engagement(spark):
    rows = [{"author_id": "a", "ts": at(d)} for d in range(1, 9)] + [{"author_id": "b", "ts": at(1, h)} for h in (1, 2)] + [{"author_id": "c", "ts": at(1)}, {"author_id": "d", "ts": at(1)}, {"author_id": "d", "ts": at(2)}]
    people = engagement.posters(messages(spark, rows))
    assert {r["kind"]: r["n_users"] for r in engagement.stickiness(people).collect()} == {"multi_week": 1, "single_day": 1, "one_time": 1, "few_day": 1}
    pareto = {r["top_n"]: r["pct"] for r in engagement.pareto(people).collect()}
    assert round(pareto[1], 3) == round(800 / 13, 3) and pareto[200] == 100
    assert engagement.shares(people).first()["poster_pct"] is None
    assert {(r["measure"], r["day"].day) for r in engagement.peaks(engagement.daily(messages(spark, rows))).collect()} == {("messages", 1), ("active", 1), ("first_posters", 1)}
    assert engagement.pareto(people.where("false")).first()["messages"] == 0 and engagement.peaks(engagement.daily(messages(spark, []))).count() == 0


def test_join_events(spark):
    df = spark.createDataFrame([(at(1), "A invited B. to the group."), (at(1), "C joined the group via QR Code shared by D. Welcome"), (at(2), "E joined the group"), (at(2), "hello"), (None, None)], "ts timestamp, content string")
    assert [tuple(r)[1:] for r in engagement.join_events(df).orderBy("ts", "joiner").collect()] == [("B", "A", "invited"), ("C", "D", "qr"), ("E", None, "qr")]


def test_merge_diff_trend(spark):
    schema = "category string, key string, value double"
    old = spark.createDataFrame([("providers", "x", 5.0), ("users", "total", 20.0), ("metadata", "total_messages", 100.0), ("date_first", "epoch", 10.0), ("date_last", "epoch", 20.0), ("providers", "gone", 1.0)], schema)
    new = spark.createDataFrame([("providers", "x", 3.0), ("users", "total", 15.0), ("metadata", "total_messages", 50.0), ("date_first", "epoch", 5.0), ("date_last", "epoch", 15.0), ("providers", "new", 2.0)], schema)
    merged = {(r["category"], r["key"]): r["value"] for r in incremental.merged(old, new).collect()}
    assert merged == {("providers", "x"): 8, ("users", "total"): 20, ("metadata", "total_messages"): 150, ("date_first", "epoch"): 5, ("date_last", "epoch"): 20, ("providers", "gone"): 1, ("providers", "new"): 2}
    changes = {(r["category"], r["key"]): r["status"] for r in incremental.differences(old, new).collect()}
    assert changes["providers", "gone"] == "gone" and changes["providers", "new"] == "new" and changes["users", "total"] == "changed"


def test_seen_store_keeps_exports_apart(spark, tmp_path):
    store = incremental.SeenStore(spark, str(tmp_path / "seen"))
    rows = spark.createDataFrame([("e1", "1"), ("e1", "1 "), ("e1", ""), ("e1", None)], "export_key string, message_id string")
    assert store.filter_new(rows).count() == 4
    store.mark(rows)
    assert store.filter_new(rows).count() == 2 and store.read().count() == 1
    assert store.filter_new(rows.withColumn("export_key", F.lit("e2"))).count() == 4


def test_top_k_blocks_and_ties(spark):
    rng = random.Random(3)
    vectors = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(4)] if i % 9 else None) for i in range(60)] + [(100, [0.0] * 4), (101, [1.0])]
    base = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    queries = base.where("vec_id % 5 = 0").withColumnRenamed("vec_id", "query_id")
    one = sorted(map(tuple, retrieval.top_k(base, queries, 7).collect()))
    assert one == sorted(map(tuple, retrieval.top_k(base, queries, 7, block=3).collect()))
    assert one == sorted(map(tuple, retrieval.top_k(base, queries, 7, block=2, pass_bytes=100).collect()))
    import numpy as np

    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
    want = []
    for q, v in vectors:
        if q % 5 == 0 and v is not None:
            scores = sorted((-round(float(unit(v) @ unit(w)), 6), b) for b, w in vectors if w is not None and len(w) == len(v))
            want += [(q, k + 1, b, -s + 0.0) for k, (s, b) in enumerate(scores[:7])]
    assert one == sorted(want)
    assert retrieval.top_k(base.where("false"), queries).count() == 0 and retrieval.top_k(base, queries.where("false")).count() == 0


def test_numbers_over_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), rng.choice([None, 1, 2]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, t int, k long").repartition(5)
    cuts = Cuts(spark, "test")
    low = lambda r: (r[1] is not None, r[1] or 0, r[2])
    for group, of in (("g", lambda r: r[0]), (None, lambda r: 0)):
        got = {r["k"]: r["n"] for r in ranges.numbered(df, group, [F.col("t"), F.col("k")], "n", cuts).collect()}
        want = {}
        for g in {of(r) for r in rows}:
            want |= {r[2]: n for n, r in enumerate(sorted((r for r in rows if of(r) == g), key=low), 1)}
        assert got == want
    assert ranges.numbered(df.where("false"), None, [F.col("k")], "n", cuts).count() == 0
    people = engagement.posters(messages(spark, [{"author_id": f"u{k % 7}", "ts": at(1)} for k in range(40)]))
    assert sorted(map(tuple, engagement.ranked(people, None).collect())) == sorted(map(tuple, engagement.ranked(people, 100).collect()))


def test_topics_cache_and_failures(spark):
    df = messages(spark, [{"message_id": "1", "content": "boom"}, {"message_id": "1", "content": "fine"}, {"content": None}, {"content": "fine"}])

    def moody(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError
        return ["bug_report" if t else "nonsense" for t in texts]

    got = {r["ord"]: r["topic"] for r in ai.tagged(df, moody).collect()}
    assert got == {0: "general_discussion", 1: "bug_report", 2: "general_discussion", 3: "bug_report"}
    cache = ai.tagged(df, moody).select("hash", "topic").distinct()
    assert {r["topic"] for r in ai.tagged(df, lambda t: 1 / 0, cache=cache).where("ord = 1").collect()} == {"bug_report"}
    assert ai.tagged(df.where("false")).count() == 0
    assert ai.parse_topics('x ```json\n[{"id": "1", "topic": "bug_report"}, {"id": 2, "topic": "?"}]```', ["1", "2"]) == {"1": "bug_report", "2": "general_discussion"}
    assert ai.parse_topics("[1]", ["1"]) is None


@pytest.mark.parametrize(("raw", "want"), [('```json\n{"a": [1, 2,],}\n```', {"a": [1, 2]}), ('so: {"a": 1} ok', {"a": 1}), ('{"a": 1} and {"b": 2}', {"b": 2}), ("", None), ("none", None), ("[1]", None)])
def test_tolerant_json(raw, want):
    assert ai.tolerant_json(raw)[0] == want


def test_chunks_are_whole(spark):
    df = messages(spark, [{"content": str(k)} for k in range(250)]).withColumn("ts_text", F.when(F.col("ord") % 7 == 0, None).otherwise((F.col("ord") % 10).cast("string")))
    sizes = sorted(r["count"] for r in ai.chunks(df).groupBy("chunk_idx").count().collect())
    assert sizes == [50, 100, 100]
