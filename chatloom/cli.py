"""Command line: analyze, crosstabs, topics, engagement, facts, retrieve, audit, survey, diff, init, dashboard.

The model behind topics, facts, findings and texts is the command in LLM_COMMAND; without one an offline
stand-in answers. CHATLOOM_CONFIG names a folder of YAML files that override the defaults.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from chatloom import config


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chatloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def source(p: argparse.ArgumentParser, needed: bool = True) -> None:
        p.add_argument("--input", required=needed)
        p.add_argument("--platform", required=needed, choices=["discord", "telegram", "canonical", "lark", "slack", "csv", "raw"])
        p.add_argument("--target-language", default="none", choices=["none", *config.languages()])
        p.add_argument("--salt-file", default=".salt")
        p.add_argument("--channel", help="name of the chat where a Lark export has none")

    a = sub.add_parser("analyze", help="statistics, users and report of an export")
    source(a)
    a.add_argument("--out", default="out")
    a.add_argument("--region", default="global", choices=list(config.regions()))
    a.add_argument("--template")
    a.add_argument("--channels", default="")
    a.add_argument("--since")
    a.add_argument("--until")
    a.add_argument("--keep-names", action="store_true")
    a.add_argument("--format", default="json", choices=["json", "csv"])
    a.add_argument("--incremental", action="store_true")
    a.add_argument("--verbose", action="store_true")
    c = sub.add_parser("crosstabs", help="pivots of an export's users, or of a users file")
    source(c, False)
    c.add_argument("--users-json")
    c.add_argument("--stats-path", help="statistics file that gets the pivots as a section")
    c.add_argument("--out", default="out")
    c.add_argument("--region", default="global", choices=list(config.regions()))
    c.add_argument("--reference-time")
    t = sub.add_parser("topics", help="topic of each message")
    source(t)
    t.add_argument("--out", default="out", help="folder of topics, topics_by_category and the cache")
    t.add_argument("--batch-size", type=int, default=25)
    t.add_argument("--concurrency", type=int, help="batches asked at once; as many as cores if not given")
    t.add_argument("--model", help="model passed on to the command")
    t.add_argument("--stats-path")
    t.add_argument("--template")
    t.add_argument("--limit", type=int)
    t.add_argument("--dry-run", action="store_true")
    e = sub.add_parser("engagement", help="concentration, stickiness and growth as JSON")
    source(e)
    e.add_argument("--out", default="out/stream_d")
    e.add_argument("--humans", type=int)
    for name, said in (("facts", "facts of chunks of 100 messages, with a cache"), ("retrieve", "findings for the configured questions"), ("audit", "brand audit and cost report")):
        x = sub.add_parser(name, help=said)
        source(x)
        x.add_argument("--out", default="out")
        x.add_argument("--product", default="the product")
        x.add_argument("--top", type=int, default=30)
    y = sub.add_parser("survey", help="narrative and final report from the results of a folder")
    y.add_argument("--out", default="out")
    y.add_argument("--title", default="Community survey")
    y.add_argument("--anchors", default="", help="verified numbers that come first")
    d = sub.add_parser("diff", help="what changed between two statistics files")
    d.add_argument("old")
    d.add_argument("new")
    d.add_argument("--format", default="text", choices=["text", "json", "csv"])
    d.add_argument("--json", action="store_true")
    i = sub.add_parser("init", help="a project folder")
    i.add_argument("folder", nargs="?", default=".")
    b = sub.add_parser("dashboard", help="a page of one or more runs, the latest last")
    b.add_argument("stats", nargs="+")
    b.add_argument("--out", default="dashboard.html")
    b.add_argument("--title", default="Community")
    b.add_argument("--chat", help="export whose first messages can be searched on the page")
    b.add_argument("--carried", type=int, default=5_000, help="messages carried by the page")
    return top


def _messages(spark, args):
    from chatloom.sinks.documents import ensure_salt
    from chatloom.sources.readers import READERS

    extra = {"channel": args.channel} if args.platform == "lark" and args.channel else {}
    return READERS[args.platform](spark, args.input, ensure_salt(args.salt_file), **extra)


def _rich(spark, args):
    from chatloom.operators import profiles

    rows = profiles.narrowed(_messages(spark, args), [c.strip() for c in getattr(args, "channels", "").split(",") if c.strip()], getattr(args, "since", None), getattr(args, "until", None))
    return rows, config.languages().get(args.target_language)


def analyze(args) -> None:
    from pyspark.sql import functions as F

    from chatloom.functions.ids import export_key
    from chatloom.operators import incremental, profiles, statistics
    from chatloom.session import local_session
    from chatloom.sinks import documents

    spark = local_session()
    out = Path(args.out)
    out.mkdir(parents=True, exist_ok=True)
    region, domains = config.regions()[args.region], config.domains()
    rows, profile = _rich(spark, args)
    store = incremental.SeenStore(spark, str(out / "state" / "seen"))
    keyed = rows.withColumn("export_key", F.lit(export_key(args.input)))
    rows = store.filter_new(keyed) if args.incremental else keyed
    rich = profiles.enriched(rows, profile, {**config.keywords(), "shadow": region.shadow}, domains).persist()
    people = profiles.user_profiles(rich).persist()
    long = statistics.statistics(rich, people, domains, region)
    before = out / "stats_long"
    if args.incremental and before.exists():
        long = incremental.merged(spark.read.parquet(str(before)), long)
    long = long.persist()
    long.count()
    long.coalesce(1).write.mode("overwrite").parquet(str(out / "stats_long.new"))
    if before.exists():
        import shutil

        shutil.rmtree(before)
    (out / "stats_long.new").rename(before)
    stats = documents.statistics_document(long, {"target_language": args.target_language, "region": args.region})
    documents.write_json(stats, out / "stats.json")
    if args.format == "csv":
        documents.write_csv(documents.flat_rows(stats), ("category", "key", "value"), out / "stats.csv")
    if not (args.incremental and (out / "users").exists() and people.isEmpty()):  # users are those of the latest run that had any
        documents.write_users(people, str(out / "users"), args.keep_names)
    if args.template:
        (out / "report.md").write_text(documents.render(Path(args.template).read_text(encoding="utf-8"), stats), encoding="utf-8")
    store.mark(rich)
    print(f"{stats['metadata'].get('total_messages', 0)} messages, results in {out}")


def crosstab(args) -> None:
    from chatloom.operators import crosstabs, profiles
    from chatloom.session import local_session
    from chatloom.sinks import documents, reports
    from chatloom.sources.results import read_users

    spark = local_session()
    if args.users_json:
        people = read_users(spark, args.users_json)
    else:
        rows, profile = _rich(spark, args)
        people = profiles.user_profiles(profiles.enriched(rows, profile, config.keywords()))
    traits = crosstabs.traits(people, config.regions()[args.region], now=args.reference_time).persist()
    out = Path(args.out)
    out.mkdir(parents=True, exist_ok=True)
    cells = crosstabs.all_pivots(traits).collect()
    nested: dict = {}
    for r in cells:
        nested.setdefault(r["pivot"], {}).setdefault(r["row_label"], {})[r["col_label"]] = r["n"]
    documents.write_json(nested, out / "crosstabs.json")
    cohort = traits.where(traits["language_primary"].isin("target_primary", "bilingual"))
    (out / "crosstabs.md").write_text("\n".join(documents.pivot_markdown(n, crosstabs.with_totals(crosstabs.pivot(cohort, r, c))) for n, (r, c) in crosstabs.PIVOTS.items()), encoding="utf-8")
    reports.merge_section(args.stats_path or out / "stats.json", "crosstabs", nested)


def topics(args) -> None:
    from pyspark.sql import functions as F

    from chatloom.operators import ai, caches, model, profiles
    from chatloom.session import local_session
    from chatloom.sinks import reports

    spark = local_session(args.concurrency or "*")
    rows, profile = _rich(spark, args)
    rich = profiles.enriched(rows, profile, {}).where(F.col("lang_class").isin("target", "mixed"))
    if args.limit:
        rich = rich.orderBy("ord").limit(args.limit)
    if args.dry_run:
        tagged = ai.tagged(rich, batch_size=args.batch_size)
    else:
        asked = model.from_environment()
        if args.model and isinstance(asked, model.Command):
            asked = model.Command(asked.command, asked.timeout, asked.retries, asked.stdin, args.model)
        language = None if args.target_language == "none" else args.target_language
        tagged = caches.tagged(rich, model.topic_tagger(asked, language), caches.topic_cache(spark, f"{args.out}/topic_cache"), args.batch_size)
    tagged = tagged.persist()
    section = reports.write_topics(tagged, args.out, args.stats_path or Path(args.out) / "stats.json", args.template)
    print(f"{section['total_tagged']} messages tagged")


def engagements(args) -> None:
    from chatloom.operators import engagement
    from chatloom.session import local_session
    from chatloom.sinks import reports
    from chatloom.sources.readers import read_raw

    spark = local_session()
    Path(args.out).mkdir(parents=True, exist_ok=True)
    joins = engagement.joins_per_day(engagement.join_events(read_raw(spark, args.input, "", keep_system=True))) if args.platform == "raw" else None
    reports.write_engagement(_messages(spark, args).drop("reactions"), args.out, joins, args.humans)


def _chunk_facts(spark, args, rows):
    from pyspark.sql import functions as F

    from chatloom.operators import ai, caches, model

    texts = ai.chunk_texts(ai.chunks(rows.withColumn("ts_text", F.col("ts").cast("string"))))
    language = "its own language" if args.target_language == "none" else args.target_language
    return caches.facts(texts, config.fact_categories(), model.fact_extractor(model.from_environment(), language), caches.FactCache(spark, f"{args.out}/fact_cache"))


def facts(args) -> None:
    from chatloom.operators import ai
    from chatloom.session import local_session
    from chatloom.sinks import documents

    spark = local_session()
    found = _chunk_facts(spark, args, _messages(spark, args)).persist()
    counts = {r["category"]: r["n"] for r in ai.fact_counts(found).collect()}  # a row a category
    documents.write_json(counts, Path(args.out) / "fact_counts.json")
    for category in counts:
        if not category.startswith("_"):
            documents.write_facts(found, category, f"{args.out}/facts/{category}")
    print(f"{sum(counts.values())} facts")


def retrieve(args) -> None:
    from chatloom.operators import caches, model, retrieval
    from chatloom.session import local_session
    from chatloom.sinks import documents, reports

    spark = local_session()
    rows = retrieval.embeddable(_messages(spark, args)).persist()
    asked = list(config.retrieval_queries(args.target_language).items())
    numbered = [(k, name, text) for k, (name, text) in enumerate(asked)]
    cache = caches.embedding_cache(spark, f"{args.out}/embedding_cache")
    base = caches.embedded(rows, "content", cache, "hashed-64")
    queries = retrieval.embedded(spark.createDataFrame(numbered, "query_id long, name string, text string"), "text")
    hits = retrieval.hits_with_messages(retrieval.top_k(base, queries, args.top, base_id="ord"), rows)
    found = reports.findings(hits, numbered, model.from_environment())
    documents.write_json(found, Path(args.out) / "findings.json")
    (Path(args.out) / "findings.md").write_text(reports.findings_text(found, rows.count()), encoding="utf-8")


def audit(args) -> None:
    from chatloom.session import local_session
    from chatloom.sinks import reports
    from chatloom.sources.results import read_facts

    spark = local_session()
    rows = _messages(spark, args).persist()
    found = read_facts(spark, f"{args.out}/fact_cache")
    out = Path(args.out)
    out.mkdir(parents=True, exist_ok=True)
    (out / "brand_audit.md").write_text(reports.brand_audit(rows, found, config.brand_patterns(), args.product), encoding="utf-8")
    (out / "token_consumption.md").write_text(reports.cost_report(rows, found, args.product), encoding="utf-8")


def survey(args) -> None:
    from chatloom.operators import model
    from chatloom.sinks import reports
    from chatloom.sources.results import read_streams

    out = Path(args.out)
    told = read_streams(out) | (read_streams(out / "stream_d") if (out / "stream_d").exists() else {})
    stats, counts = told.get("stats", {}), told.get("fact_counts", {})
    strong = model.from_environment(strong=True)
    prompt = reports.narrative_prompt(stats, told.get("findings", {}), counts, told.get("temporal_growth", []), args.anchors)
    narrative = reports.cleaned_answer(strong(prompt))
    (out / "narrative.md").write_text(narrative, encoding="utf-8")
    (out / "final_report.md").write_text(reports.final_report(narrative, stats, counts, strong, args.title), encoding="utf-8")


def diff(args) -> None:
    from chatloom.operators.incremental import differences
    from chatloom.session import local_session
    from chatloom.sinks import documents

    spark = local_session()

    def long(path: str):
        rows = []
        for category, key, value in documents.flat_rows(json.loads(Path(path).read_text(encoding="utf-8"))):
            try:
                rows.append((category, key, float(value)))
            except ValueError:
                continue
        return spark.createDataFrame(rows, "category string, key string, value double")

    changes = differences(long(args.old), long(args.new))
    if args.json or args.format == "json":
        print(json.dumps([r.asDict() for r in changes.orderBy("category", "key").collect()], indent=2, ensure_ascii=False))
    elif args.format == "csv":
        print("category,key,old_value,new_value,delta,status")
        for r in changes.orderBy("category", "key").collect():
            print(",".join(str(r[c]) for c in ("category", "key", "old_value", "new_value", "delta", "status")))
    else:
        print(documents.difference_text(changes), end="")


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "init":
        from chatloom.sinks.documents import scaffold

        print("made: " + ", ".join(scaffold(args.folder)))
    elif args.command == "dashboard":
        from chatloom.sinks.dashboard import page
        from chatloom.sources.results import read_documents

        runs, messages = read_documents(args.stats), []
        if args.chat:
            from chatloom.session import local_session
            from chatloom.sources.readers import read_chat

            messages = [r.asDict() for r in read_chat(local_session(), args.chat, "").orderBy("ord").limit(args.carried).collect()]
        Path(args.out).write_text(page(runs[-1], args.title, runs[:-1], messages=messages, keywords=config.keywords(), titles=config.labels()), encoding="utf-8")
    else:
        {
            "analyze": analyze, "crosstabs": crosstab, "topics": topics, "diff": diff, "engagement": engagements, "facts": facts, "retrieve": retrieve, "audit": audit, "survey": survey,
        }[args.command](args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
