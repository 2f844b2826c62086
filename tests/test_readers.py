"""Readers against small hand-written exports."""

import json
import zipfile

import pytest

from chatloom.sources import readers as R


def put(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def got(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("ord").collect()]


def test_discord(spark, tmp_path):
    doc = {"channel": {"name": "help"}, "messages": [
        {"id": "1", "author": {"id": "a", "name": "Ann", "nickname": "annie"}, "timestamp": "2026-01-10T09:00:00+02:00", "content": "hi", "reactions": [{"emoji": {"name": "x"}, "count": 2}], "attachments": [{}]},
        {"id": 2, "author": None, "timestamp": "nonsense", "content": None, "reference": {"messageId": "1"}},
    ]}
    df = R.read_discord(spark, put(tmp_path / "d.json", doc), "s")
    assert got(df, "channel", "message_id", "author_name", "content", "reply_to_message_id", "attachment_count") == [("help", "1", "annie", "hi", None, 1), ("help", "2", "unknown", "", "1", 0)]
    rows = df.orderBy("ord").collect()
    assert str(rows[0]["ts"]).startswith("2026-01-10 07:00:00") and rows[1]["ts"] is None
    assert rows[0]["reactions"][0]["emoji"] == "x" and rows[0]["reactions"][0]["count"] == 2


def test_telegram_text_shapes(spark, tmp_path):
    doc = {"name": "tg", "messages": [
        {"id": 1, "type": "message", "date": "2026-01-10T09:00:00", "from_id": "u1", "from": "A", "text": "plain"},
        {"id": 2, "type": "service", "text": "x"},
        {"id": 3, "type": "message", "from": None, "text": ["see ", {"type": "link", "text": "http://a"}, " ok"], "reply_to_message_id": 1, "photo": "p"},
    ]}
    df = R.read_telegram(spark, put(tmp_path / "t.json", doc), "s")
    assert got(df, "message_id", "author_name", "content", "reply_to_message_id", "attachment_count") == [("1", "A", "plain", None, 0), ("3", "unknown", "see http://a ok", "1", 1)]


def test_canonical_keeps_hashed_ids(spark, tmp_path):
    doc = {"messages": [{"author_id": "sha256:abc", "message_id": "m", "timestamp": "2026-01-01T00:00:00Z", "content": "c"}, {"author_id": "u"}]}
    rows = R.read_canonical(spark, put(tmp_path / "c.json", doc), "s").orderBy("ord").collect()
    assert rows[0]["author_id"] == "sha256:abc" and len(rows[1]["author_id"]) == 16


@pytest.mark.parametrize("shape", ["ndjson", "array", "items", "messages", "canonical"])
def test_lark_shapes(spark, tmp_path, shape):
    native = [
        {"message_id": "om_1", "msg_type": "text", "content": json.dumps({"text": "hello"}), "create_time": "1764559271012", "sender": {"sender_id": {"open_id": "ou"}, "name": "N"}, "chat_id": "oc"},
        {"message_id": "om_2", "msg_type": "image", "body": {"content": json.dumps({"image_key": "k"})}, "create_time": "2026-04-23 15:48", "sender": {"id": "z"}, "parent_id": "om_1"},
    ]
    canonical = {"messages": [{"platform": "canonical", "author_id": "a", "message_id": "om_1", "content": "hello", "channel": "ch", "timestamp": "2025-12-01T03:21:11.012Z"}]}
    text = {
        "ndjson": "\n".join(map(json.dumps, native)) + "\nbroken{", "array": json.dumps(native), "items": json.dumps({"code": 0, "data": {"items": native}}),
        "messages": json.dumps({"data": {"messages": native}}), "canonical": json.dumps(canonical),
    }[shape]
    df = R.read_lark(spark, put(tmp_path / "l.json", text), "s")
    rows = got(df, "message_id", "content", "channel", "attachment_count", "reply_to_message_id")
    if shape == "canonical":
        assert rows == [("om_1", "hello", "ch", 0, None)]
    else:
        assert rows == [("om_1", "hello", "oc", 0, None), ("om_2", "[Image: k]", "oc", 1, "om_1")]
    assert str(df.orderBy("ord").first()["ts"]).startswith("2025-12-01 03:21:11")


def test_lark_content_types(spark, tmp_path):
    cases = [
        ("post", {"title": "T", "content": [[{"text": "a"}, {"tag": "img"}], [{"text": "b"}]]}, "[title: T]\na\nb"), ("file", {"file_name": "f.txt"}, "[File: f.txt]"),
        ("system", {"template": "{from_user} invited {to_chatters}", "from_user": ["A", "B"], "to_chatters": ["C"]}, "[System: A, B invited C]"), ("interactive", {}, "[Card]"),
        ("sticker", {}, "[Sticker: ?]"), ("weird", {}, "[weird]"), ("text", "{broken", "[text: <unparseable>]"), ("text", "plain", "plain"), ("share_user", {"user_id": "u"}, "[Shared user: u]"),
    ]
    lines = [json.dumps({"message_id": str(k), "msg_type": t, "content": c if isinstance(c, str) else json.dumps(c)}) for k, (t, c, _) in enumerate(cases)]
    df = R.read_lark(spark, put(tmp_path / "l.ndjson", "\n".join(lines)), "s", channel="x")
    assert [c for (c,) in got(df, "content")] == [want for _, _, want in cases]


def test_slack_file_directory_zip(spark, tmp_path):
    messages = [
        {"type": "message", "user": "U1", "ts": "1744006285.156415", "text": "a", "thread_ts": "1744006285.156415"}, {"type": "message", "user": "U2", "ts": "1744006286.0", "text": "b", "thread_ts": "1744006285.156415", "files": [{}]},
        {"type": "message", "user": "B1", "ts": "1", "text": "bot"}, {"type": "message", "subtype": "channel_join", "user": "U3", "ts": "2", "text": "joined"}, {"type": "message", "ts": "1744006287.5", "text": "nobody"},
    ]
    want = [("general", "1744006285.156415", "a", None, 0), ("general", "1744006286.0", "b", "1744006285.156415", 1), ("general", "1744006287.5", "nobody", None, 0)]
    columns = ("channel", "message_id", "content", "reply_to_message_id", "attachment_count")
    folder = tmp_path / "slack"
    folder.mkdir()
    put(folder / "general.json", messages)
    put(folder / "zz.json", {"messages": messages[:1]})
    assert got(R.read_slack(spark, str(folder / "general.json"), "s"), *columns) == want
    assert got(R.read_slack(spark, str(folder), "s"), *columns) == want + [("zz", *want[0][1:])]
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("x/general.json", json.dumps(messages))
    assert got(R.read_slack(spark, str(tmp_path / "s.zip"), "s"), *columns) == want


def test_csv_aliases(spark, tmp_path):
    text = 'Text ,USER,User_ID,Time,channel_name,ID,reply_to\n"hello, ""you""\nthere",ann,7,2026-01-10 09:00:00,c,1,\n,bob,8,,,,\nhi,bob,,bad,,2,1\n'
    df = R.read_csv(spark, put(tmp_path / "x.csv", text), "s")
    assert got(df, "content", "author_name", "channel", "message_id", "reply_to_message_id") == [('hello, "you"\nthere', "ann", "c", "1", None), ("hi", "bob", "csv-import", "2", "1")]


def test_raw_lines(spark, tmp_path):
    lines = [{"message_id": "1", "content": "hello", "sender": {"id": "a", "name": "A"}, "create_time": "2026-01-01 00:00"}, {"msg_type": "system", "content": "A joined the group"}, {"content": {"text": "hi there"}}, {"content": "x"}]
    path = put(tmp_path / "r.ndjson", "\n".join(map(json.dumps, lines)) + "\nnot json")
    assert got(R.read_raw(spark, path, "s", least=3, cut=4), "content") == [("hell",), ("hi t",)]
    assert len(got(R.read_raw(spark, path, "s", keep_system=True), "content")) == 4


def test_empty_files(spark, tmp_path):
    for name in ("discord", "telegram", "canonical", "lark", "slack"):
        assert R.READERS[name](spark, put(tmp_path / f"{name}.json", ""), "s").count() == 0


def _large(n, make):
    return ",".join(make(i) for i in range(n))


@pytest.mark.parametrize("platform", ["discord", "telegram", "canonical", "slack", "lark", "zip"])
def test_large_exports_are_whole(spark, tmp_path, platform):
    """20 MiB a file: more than a VARIANT holds. Every message comes out, in order."""
    n, text = 2_200, "x" * 10_000
    made = {
        "discord": lambda i: json.dumps({"id": str(i), "author": {"id": "a"}, "content": text}), "telegram": lambda i: json.dumps({"id": i, "type": "message", "text": text}),
        "canonical": lambda i: json.dumps({"message_id": str(i), "content": text}), "slack": lambda i: json.dumps({"type": "message", "ts": f"{i}", "user": "U", "text": text}),
        "lark": lambda i: json.dumps({"message_id": str(i), "msg_type": "text", "content": text}), "zip": lambda i: json.dumps({"type": "message", "ts": f"{i}", "user": "U", "text": text}),
    }[platform]
    body = _large(n, made)
    whole = f'{{"channel": {{"name": "big"}}, "name": "big", "messages": [{body}]}}' if platform in ("discord", "telegram", "canonical") else f'{{"data": {{"items": [{body}]}}}}' if platform == "lark" else f"[{body}]"
    path = put(tmp_path / "big.json", whole)
    if platform == "zip":
        path = str(tmp_path / "big.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.write(tmp_path / "big.json", "big.json")
    df = R.READERS["slack" if platform == "zip" else platform](spark, path, "s")
    rows = df.select("ord", "message_id", "channel", "content").orderBy("ord").collect()
    assert [r["message_id"] for r in rows] == [str(i) for i in range(n)] and {len(r["content"]) for r in rows} == {len(text)}
    if platform in ("discord", "telegram"):
        assert {r["channel"] for r in rows} == {"big"}


def test_export_of_140_mib(spark, tmp_path):
    n = 14_000
    path = put(tmp_path / "big.json", f'{{"channel": {{"name": "big"}}, "messages": [{_large(n, lambda i: json.dumps({"id": str(i), "content": "x" * 10_000}))}]}}')
    assert R.read_discord(spark, path, "s").select("message_id").distinct().count() == n


def test_small_and_large_files_read_alike(spark, tmp_path, monkeypatch):
    doc = {"channel": {"name": "c"}, "messages": [{"id": 1, "author": {"id": "a", "name": "n"}, "timestamp": "2026-01-10T09:00:00Z", "content": "é", "reactions": [{"emoji": {"name": "x"}, "count": 1.0}]}, {"id": 2}, None]}
    (tmp_path / "d").mkdir()
    put(tmp_path / "d" / "a.json", doc)
    put(tmp_path / "d" / "b.json", {**doc, "channel": None})
    put(tmp_path / "d" / "c.json", "broken{")
    rows = [sorted(map(str, R.read_discord(spark, str(tmp_path / "d"), "s").collect()))]
    documents = R._documents
    monkeypatch.setattr(R, "_documents", lambda *a, **k: documents(*a, **{**k, "large": 0}))
    rows.append(sorted(map(str, R.read_discord(spark, str(tmp_path / "d"), "s").collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 6


def test_lark_lines_of_many_items_keep_their_order(spark, tmp_path):
    """Item 65 536 of a line comes before the next line's."""
    n = 66_000
    line = lambda start, k: json.dumps({"data": {"items": [{"message_id": str(start + i)} for i in range(k)]}})
    path = put(tmp_path / "l.ndjson", line(0, n) + "\n" + line(n, 3))
    rows = R.read_lark(spark, path, "s").select("ord", "message_id").orderBy("ord").collect()
    assert len({r["ord"] for r in rows}) == n + 3 and [int(r["message_id"]) for r in rows] == list(range(n + 3))


def test_small_inputs_are_dealt_out(spark):
    from chatloom.session import spread

    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and sorted(r[0] for r in spread(one).collect()) == list(range(100))
    assert spread(one, 10).rdd.getNumPartitions() == 1 and spread(spark.range(100).repartition(3)).rdd.getNumPartitions() == 3 and spread(one.where("id < 0")).count() == 0
