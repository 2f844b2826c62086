"""Sinks, the command line end to end, and the streaming forms."""

import json

from pyspark.sql import functions as F

from chatloom.operators.incremental import SeenStore
from chatloom.sinks import dashboard, documents
from chatloom.streaming import live


def test_render():
    stats = {"a": {"b": [1, {"c": None}]}, "d": {"x": 1}}
    assert documents.render(r"{{stats.a.b.0}} {{ stats.a.b.1.c }} {{stats.q}} \{{stats.a}} {{other}}", stats) == "1 <none> <missing:stats.q> {{stats.a}} {{other}}"
    assert '"x": 1' in documents.render("{{stats.d}}", stats)


def test_flat_rows():
    rows = documents.flat_rows({"top": 3, "c": {"k": 1, "n": None, "l": [1, 2], "d": {"s": 2, "deep": {"x": 1}}}})
    assert rows == [("root", "top", "3"), ("c", "k", "1"), ("c", "l", "1,2"), ("c", "d.s", "2")]


def test_dashboard_escapes():
    text = dashboard.page({"metadata": {"total_messages": 10}, "friction_signals": {"<b>": 5}, "help_answered": {"rate": 0.8}}, "T<", samples={"x": ["<script>"]})
    assert "<b>" not in text and "<script>&" not in text and "&lt;script&gt;" in text and "50%" in text


def test_salt_and_scaffold(tmp_path):
    salt = documents.ensure_salt(tmp_path / "p" / ".salt")
    assert salt == documents.ensure_salt(tmp_path / "p" / ".salt") and len(salt) == 64 and (tmp_path / "p" / ".salt").stat().st_mode & 0o777 == 0o600
    assert documents.scaffold(tmp_path / "q") and documents.scaffold(tmp_path / "q") == []


def test_cli_end_to_end(spark, tmp_path, monkeypatch):
    import chatloom.session
    from chatloom import cli

    monkeypatch.setattr(chatloom.session, "local_session", lambda *a, **k: spark)
    messages = [{"platform": "x", "channel": "c", "message_id": str(k), "author_id": f"u{k % 5}", "author_name": f"n{k % 5}", "timestamp": f"2026-01-{1 + k:02d}T10:00:00Z", "content": "how do I use cargo on discord?" if k % 4 == 0 else "all fine", "reply_to_message_id": str(k - 1) if k % 4 == 1 else None} for k in range(20)]
    export, out = tmp_path / "e.json", tmp_path / "out"
    export.write_text(json.dumps({"messages": messages}))
    (tmp_path / "t.md").write_text("N={{stats.metadata.total_messages}}")
    args = ["analyze", "--input", str(export), "--platform", "canonical", "--out", str(out), "--salt-file", str(tmp_path / ".salt"), "--template", str(tmp_path / "t.md"), "--format", "csv", "--incremental"]
    assert cli.main(args) == 0
    stats = json.loads((out / "stats.json").read_text())
    assert stats["metadata"]["total_messages"] == 20 and stats["users"]["total"] == 5 and stats["providers"]["cargo"] == 5 and stats["messaging_platforms"]["discord"] == 5
    assert stats["help_answered"] == {"questions": 5, "target_questions": 5, "answered": 5, "rate": 1} and (out / "report.md").read_text() == "N=20"
    assert cli.main(args) == 0  # a second run over the same export adds nothing
    again = json.loads((out / "stats.json").read_text())
    assert again["metadata"]["total_messages"] == 20 and again["providers"]["cargo"] == 5
    assert "redacted" in "".join(p.read_text() for p in (out / "users").glob("*.json"))
    assert cli.main(["crosstabs", *args[1:5], "--out", str(out), "--salt-file", str(tmp_path / ".salt")]) == 0
    assert "install_x_friction" in json.loads((out / "crosstabs.json").read_text())
    assert cli.main(["dashboard", str(out / "stats.json"), "--out", str(tmp_path / "d.html")]) == 0
    assert cli.main(["diff", str(out / "stats.json"), str(out / "stats.json")]) == 0


def _stream(spark, folder):
    schema = "export_key string, message_id string, author_id string, channel string, ts timestamp, reply_to_message_id string"
    return spark.readStream.schema(schema).json(str(folder))


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [{"export_key": "e", "message_id": str(k % 6), "author_id": f"a{k % 3}", "channel": "c", "ts": f"2026-01-01T0{k % 6}:00:00Z", "reply_to_message_id": None if k % 2 == 0 else str(k % 6 - 1)} for k in range(12)]
    (source / "1.json").write_text("\n".join(map(json.dumps, rows)))
    seen: list[int] = []
    store = SeenStore(spark, str(tmp_path / "seen"))
    for n in range(2):
        query = live.incremental_runs(_stream(spark, source), store, lambda df, k: seen.append(df.count()), str(tmp_path / f"cp{n}"))
        query.awaitTermination(120)
    assert seen[0] == 12 and seen[1:] in ([0], [])
    for name, df, mode, want in (("dd", live.deduplicated(_stream(spark, source)), "append", 6), ("an", live.answered(_stream(spark, source), _stream(spark, source)), "append", None), ("dc", live.daily_counts(_stream(spark, source)), "complete", 1)):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination(120)
        n = spark.table(name).count()
        assert n > 0 if want is None else n == want
    assert spark.table("dc").agg(F.sum("messages")).first()[0] == 12
