"""Reports made of results: brand audit, cost, findings, narrative, final report (K9, X6, X7, F35), and what is
merged into a statistics document (K5, K6, K10).

Counts and samples are made by Spark; only aggregates, samples of fixed size and texts of models reach the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import java_pattern
from chatloom.operators import ai, engagement, profiles
from chatloom.operators.model import Model, ModelError, offline
from chatloom.sinks.documents import render, write_json

SAMPLES = 40  #: incidents and complaints shown in a report


def _lines(*parts: str | Sequence[str]) -> str:
    out: list[str] = []
    for p in parts:
        out += [p] if isinstance(p, str) else list(p)
    return "\n".join(out) + "\n"


def branded(messages: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Messages with `mentions`, the brands whose pattern is found in the text, whatever its case."""
    text = F.coalesce("content", F.lit(""))
    hits = [F.when(text.rlike("(?iu)" + java_pattern(p)), F.struct(F.lit("brand").alias("category"), F.lit(k).alias("pos"), F.lit(label).alias("label"))) for k, (label, p) in enumerate(patterns.items())]
    return messages.withColumn("mentions", F.array_compact(F.array(*hits)) if hits else F.array().cast("array<struct<category:string,pos:int,label:string>>"))


def brand_audit(messages: DataFrame, found: DataFrame, patterns: Mapping[str, str], product: str) -> str:
    """K9: how often each brand is named, first messages of each, and facts on brand confusion."""
    rows = branded(messages, patterns)
    total = messages.count()
    counts = profiles.mention_counts(rows).orderBy(F.desc("n"), "label").collect()  # a row a brand
    samples = profiles.first_samples(rows, "brand").join(messages.select(F.col("ord").alias("_o"), "author_name", "ts"), F.col("ord") == F.col("_o")).orderBy("label", "k").collect()
    confused = found.where(F.col("category") == "brand_confusion")
    ends = ai.resolutions(found).orderBy(F.desc("n"), "resolution").collect()
    shown = ai.sample(confused.withColumn("_k", F.to_json("fact")), "_k", SAMPLES, 0).collect()
    of = {r["label"]: [s for s in samples if s["label"] == r["label"]] for r in counts}
    told = lambda r, field: str((r["fact"] or {}).get(field) or "?").replace("\n", " ")[:200]
    return _lines(
        f"# Brand audit: {product}", "", f"{total:,} messages were searched.", "", "## Counts", "", "| brand | messages |", "|---|---:|", [f"| `{r['label']}` | {r['n']:,} |" for r in counts],
        "", "## First messages of each", "",
        [line for label, some in of.items() for line in [f"### {label}", "", *[f"- **{s['author_name'] or '?'}** ({s['ts'] or ''}): {s['sample']}" for s in some], ""]],
        "## Confusion told in the chat", "", f"Facts: {sum(r['n'] for r in ends)}", "", [f"- {r['resolution']}: {r['n']}" for r in ends], "", "### Samples", "",
        [f"- [{told(r, 'resolution')}] **{told(r, 'user_ref')}**: {told(r, 'question')}" for r in shown],
    )


def cost_report(messages: DataFrame, found: DataFrame, product: str) -> str:
    """K9: complaints about cost (P11), a sample of them, amounts that are named, and facts on the product's price."""
    hits = messages.where(ai.is_cost_complaint(F.col("content")))
    summary = hits.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(ai.amounts(F.col("content")))).alias("amounts")).first()
    shown = ai.sample(hits, "ord", SAMPLES, 1).select("author_name", "ts", F.substring(F.translate("content", "\n", " "), 1, 400).alias("quote")).collect()
    priced = ai.about_product(found, product).limit(1_000).collect()
    return _lines(
        f"# Cost: {product}", "", f"Complaints: {summary['n']:,}; amounts named in them: {summary['amounts'] or 0:,}", "", "## Sample", "", [f"- **{r['author_name'] or '?'}** ({r['ts'] or ''}): {r['quote']}" for r in shown],
        "", f"## Facts on the price of {product}", "", [f"- **{(r['fact'] or {}).get('user_ref', '?')}** ({r['fact'].get('service')}): {r['fact'].get('issue', '?')}" for r in priced],
    )


# --- findings and narrative ---------------------------------------------------------------------


def findings(hits: DataFrame, queries: Sequence[tuple[int, str, str]], model: Model = offline) -> dict[str, dict[str, Any]]:
    """By name what a model says of the messages found for each query (number, name, text).

    `hits` are those of `retrieval.hits_with_messages`. A model that fails leaves its reason in brackets.
    """
    rows = hits.orderBy("query_id", "rank").collect()  # a few dozen hits a query
    out: dict[str, dict[str, Any]] = {}
    for number, name, text in queries:
        mine = [r for r in rows if r["query_id"] == number]
        prompt = _lines(
            "These messages of a community chat were found for a question, nearest first.", f"Question: {name}: {text}", "", [f"[{r['rank']}] ({r['score']:.2f}) {r['content']}" for r in mine], "",
            "Write 150 to 200 words in English on what they show together. Cite messages by number in brackets. Say so if they show little.",
        )
        try:
            said = model(prompt)
        except ModelError as e:
            said = f"[{e}]"
        out[name] = {"query": text, "analysis": said, "source_count": len(mine)}
    return out


def findings_text(found: Mapping[str, Mapping[str, Any]], n_messages: int) -> str:
    """K9: findings as Markdown."""
    return _lines("# Findings by retrieval", "", f"{n_messages:,} messages, {len(found)} questions", "", [line for name, f in found.items() for line in (f"## {name}", "", f"*{f['query']}* ({f['source_count']} messages)", "", f["analysis"], "")])


#: Sections of a narrative, in order.
SECTIONS = (
    "Executive Summary", "Who Are They", "What Do They Talk About", "Providers", "Messaging Platforms", "Installing and Setup", "Competitors",
    "Brand and Confusion", "Shared Keys", "Prices", "Network Friction", "Wishes and Successes", "Help", "Voices",
)


def narrative_prompt(document: Mapping[str, Any], found: Mapping[str, Mapping[str, Any]], facts: Mapping[str, int], growth: Sequence[Mapping[str, Any]], anchors: str = "") -> str:
    """What a model gets to write the survey: verified anchors, statistics, findings, fact counts, and the days
    of growth that tell most (first five, the peak, last three)."""
    days = list(growth)
    peak = [max(days, key=lambda d: d.get("joined", 0))] if days else []
    shown = days[:5] + peak + days[-3:]
    small = {k: v for k, v in document.items() if k in ("metadata", "language_distribution", "location_proxy", "help_answered", "topics", "retention")}
    as_json = lambda x: json.dumps(x, ensure_ascii=False, default=str)
    return _lines(
        "Write a survey of a chat community in Markdown. Describe; recommend nothing. Cite the numbers below, the verified ones first.", "", "VERIFIED", anchors or "(nothing)", "", "STATISTICS", as_json(small), "", "FINDINGS",
        [f"[{name}] {f['analysis'][:900]}" for name, f in found.items()], "", "FACTS BY CATEGORY", as_json(dict(facts)), "", "GROWTH", as_json(shown), "",
        "Sections, each under a heading of the form '## N. Title':", [f"{k}. {title}" for k, title in enumerate(SECTIONS, 1)],
    )


def cleaned_answer(text: str) -> str:
    """a model's answer without lines of its tool (warnings, notes on iterations or files) and a leading rule."""
    kept = [x for x in text.split("\n") if not x.startswith(("\u26a0\ufe0f", "The file", "session_id:")) and "maximum iterations" not in x and "file write failed" not in x.lower()]
    return re.sub(r"^-{3,}\s*\n", "", "\n".join(kept).strip(), count=1)


def split_report(text: str) -> tuple[str, str]:
    """(the first section, the others numbered from 1) of a text with headings "## N. Title"."""
    parts = re.split(r"^## (\d+)\. ", text, flags=re.MULTILINE)
    rest = [f"## {int(n) - 1}. {body.rstrip()}" for n, body in zip(parts[3::2], parts[4::2])]
    return (parts[2] if len(parts) > 2 else ""), "\n\n".join(rest)


def final_report(narrative: str, document: Mapping[str, Any], fact_counts: Mapping[str, int], model: Model = offline, title: str = "Community survey", method: str = "") -> str:
    """K9: summary, findings, recommendations by a model, method and the files it rests on."""
    summary, body = split_report(narrative)
    topics = document.get("topics", {}).get("counts", {})
    prompt = _lines(
        "Write the recommendations of a survey, decisively and with its numbers: a paragraph of what matters most, eight to fourteen recommendations (bold title, tier P0, P1, P2 or Watch, reason, effort, impact, risk), "
        "what is not recommended, and open questions. Markdown alone, beginning with '### A.'.", "", body[:20_000], "", json.dumps({"topics": topics, "facts": dict(fact_counts)}, ensure_ascii=False),
    )
    try:
        advice = cleaned_answer(model(prompt))
    except ModelError as e:
        advice = f"[{e}]"
    heading = summary.split("\n", 1)
    return _lines(f"# {title}", "", "## Summary", "", heading[1].strip() if len(heading) > 1 else summary.strip(), "", "## Findings", "", body, "", "## Recommendations", "", advice, "", "## Method", "", method or "Counts are of all messages; texts are by a model.")


# --- documents that grow ------------------------------------------------------------------------


def merge_section(path: str | Path, name: str, value: Any) -> bool:
    """K5, K6: put a section into a statistics file, if the file is there."""
    target = Path(path)
    if not target.exists():
        return False
    document = json.loads(target.read_text(encoding="utf-8"))
    document[name] = value
    write_json(document, target)
    return True


def write_topics(topics: DataFrame, folder: str, stats: str | Path | None = None, template: str | Path | None = None) -> dict[str, Any]:
    """K6: topic of each message as JSON lines, ids by topic as JSON partitioned by it, both written by Spark; counts merged
    into the statistics file, and its report rendered again, where these are given. Gives the counts."""
    topics.select("message_id", "topic").write.mode("overwrite").json(f"{folder}/topics")
    ordered = topics.select("topic", "message_id").repartitionByRange("topic", "message_id").sortWithinPartitions("topic", "message_id")
    ordered.write.mode("overwrite").partitionBy("topic").json(f"{folder}/topics_by_category")
    counts = {r["topic"]: r["n"] for r in ai.topic_distribution(topics).orderBy(F.desc("n"), "topic").collect()}  # a row a topic
    section = {"total_tagged": sum(counts.values()), "counts": counts, "by_category": counts}
    if stats is not None and merge_section(stats, "topics", section) and template is not None:
        document = json.loads(Path(stats).read_text(encoding="utf-8"))
        (Path(stats).parent / "report.md").write_text(render(Path(template).read_text(encoding="utf-8"), document), encoding="utf-8")
    return section


def write_engagement(posts: DataFrame, folder: str | Path, joins: DataFrame | None = None, humans: int | None = None) -> dict[str, Any]:
    """user_pareto.json, user_stickiness.json and temporal_growth.json of the posts; humans alone count for the
    concentration. Gives the three documents."""
    people = engagement.posters(posts).persist()
    try:
        own = people.where(F.col("kind") != "app")
        growth = engagement.growth(engagement.daily(posts.where(F.coalesce("sender_type", F.lit("user")) != "app") if "sender_type" in posts.columns else posts), joins)
        out = {
            "user_pareto": {"human_concentration": {f"top_{r['top_n']}": {"messages": r["messages"], "pct": r["pct"]} for r in engagement.pareto(own).orderBy("top_n").collect()}},
            "user_stickiness": {"classes": {r["kind"]: r["n_users"] for r in engagement.stickiness(own).collect()}, "rates": engagement.shares(people, humans).first().asDict()},
            "temporal_growth": [{**r.asDict(), "day": r["day"].isoformat()} for r in growth.orderBy("day").collect()],  # a row a day
        }
    finally:
        people.unpersist()
    for name, document in out.items():
        write_json(document, Path(folder) / f"{name}.json")
    return out
