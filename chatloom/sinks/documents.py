"""Small results as documents: statistics JSON and CSV, users, reports, pivots, differences, fact CSVs.

Only aggregated rows are collected here (a row a label, channel, day or user cohort); tables that
grow with the data, such as users, are written by Spark.
"""

from __future__ import annotations

import csv
import io
import json
import os
import re
import secrets
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More distinct labels than this in one statistics table are refused rather than collected.
MOST_ROWS = 1_000_000


def _plain(value: float | None) -> int | float | None:
    return int(value) if value is not None and float(value).is_integer() else value


def statistics_document(rows: DataFrame, metadata: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The nested document of long statistics; counters in descending order, ties by name."""
    found = rows.limit(MOST_ROWS + 1).collect()
    if len(found) > MOST_ROWS:
        raise ValueError("too many statistics rows for one document")
    out: dict[str, Any] = {"metadata": dict(metadata or {})}
    dates: dict[str, float] = {}
    for r in sorted(found, key=lambda r: (r["category"], -(r["value"] if r["value"] is not None else float("-inf")), str(r["key"]))):
        category, key, value = r["category"], r["key"], _plain(r["value"])
        if category in ("date_first", "date_last"):
            dates[category] = value
        elif category == "metadata" or category.startswith("channel_"):
            where = out["metadata"] if category == "metadata" else out["metadata"].setdefault(category, {})
            where[key] = value
        elif category in ("url_categories", "top_domains", "impersonator_domains", "official_domains"):
            out.setdefault("urls", {}).setdefault({"url_categories": "category_counts"}.get(category, category), {})[key] = value
        else:
            out.setdefault(category, {})[key] = value
    if dates:
        import datetime as dt

        iso = lambda s: None if s is None else dt.datetime.fromtimestamp(s, dt.timezone.utc).isoformat()
        out["metadata"]["date_range"] = [iso(dates.get("date_first")), iso(dates.get("date_last"))]
    if "acquisition_markers" in out:
        out["acquisition_channels"] = out["acquisition_markers"]  # a name that report templates use
    return out


def write_json(value: Any, path: str | Path) -> None:
    """K1: indented UTF-8."""
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8")


def flat_rows(document: Mapping[str, Any]) -> list[tuple[str, str, str]]:
    """K2: (category, key, value) of a document: scalars, one nested level as key.subkey, lists joined
    by commas; nulls and deeper levels are left out; what isn't in a category is in root."""
    rows: list[tuple[str, str, str]] = []

    def add(category: str, key: str, value: Any) -> None:
        if isinstance(value, (list, tuple)):
            rows.append((category, key, ",".join(str(v) for v in value)))
        elif value is not None and not isinstance(value, Mapping):
            rows.append((category, key, str(value)))

    for category, content in document.items():
        if not isinstance(content, Mapping):
            add("root", category, content)
            continue
        for key, value in content.items():
            if isinstance(value, Mapping):
                for inner, v in value.items():
                    if not isinstance(v, (Mapping, list, tuple)):
                        add(category, f"{key}.{inner}", v)
            else:
                add(category, key, value)
    return rows


def write_csv(rows: Sequence[Sequence[Any]], header: Sequence[str], path: str | Path, bom: bool = False) -> None:
    buffer = io.StringIO()
    writer = csv.writer(buffer)
    writer.writerow(header)
    writer.writerows(rows)
    Path(path).write_bytes((b"\xef\xbb\xbf" if bom else b"") + buffer.getvalue().encode("utf-8"))


def write_users(profiles: DataFrame, path: str, keep_names: bool = False) -> None:
    """One JSON line a user, written by Spark; names are redacted unless they are to be kept."""
    name = F.col("display_name") if keep_names else F.lit("<redacted>")
    profiles.withColumn("display_name", name).write.mode("overwrite").json(path)


def write_users_keyed(profiles: DataFrame, path: str | Path, keep_names: bool = False, most: int = MOST_ROWS) -> None:
    """K3 as one JSON object keyed by user, for tools that want a single file. Users are written one by one as they
    come; more than `most` are refused, for them there is `write_users`."""
    name = F.col("display_name") if keep_names else F.lit("<redacted>")
    rows = profiles.withColumn("display_name", name).orderBy("author_id").select("author_id", F.to_json(F.struct("*")).alias("j"))
    if rows.limit(most + 1).count() > most:
        raise ValueError("too many users for one file")
    with Path(path).open("w", encoding="utf-8") as f:
        f.write("{")
        for k, r in enumerate(rows.toLocalIterator()):
            f.write(("," if k else "") + "\n" + json.dumps(r["author_id"], ensure_ascii=False) + ": " + r["j"])
        f.write("\n}\n")


def write_facts(found: DataFrame, category: str, path: str, most: int = 1_000) -> list[str]:
    """A category's facts as CSV with a byte-order mark, one column a field that any of them has.

    Spark writes the folder, a file a partition in the order of chunks, so no task and no driver meets
    all facts. More than `most` different fields (data used as keys) are refused. Gives the fields.
    """
    rows = found.where(F.col("category") == category)
    keys = [r["k"] for r in rows.select(F.explode(F.map_keys("fact")).alias("k")).distinct().orderBy("k").limit(most + 1).collect()]
    if len(keys) > most:
        raise ValueError(f"more than {most} different fields")
    cells = rows.select("chunk_idx", *[F.coalesce(F.try_element_at("fact", F.lit(k)), F.lit("")).alias(k) for k in keys])
    marked = cells.withColumnRenamed("chunk_idx", "\ufeffchunk_idx").repartitionByRange("\ufeffchunk_idx").sortWithinPartitions("\ufeffchunk_idx")
    marked.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return keys


def render(template: str, document: Mapping[str, Any]) -> str:
    """K4: {{stats.a.b.0}} replaced by the value there; <missing:path> and <none> tell of gaps; \\{{ is
    an escaped brace; dictionaries and lists are shown as JSON."""

    def resolve(m: re.Match) -> str:
        if m.group(1) is None:
            return "{{"
        path = m.group(1).strip()
        if not path.startswith("stats."):
            return m.group(0)
        at: Any = document
        for part in path.split(".")[1:]:
            if isinstance(at, Mapping) and part in at:
                at = at[part]
            elif isinstance(at, (list, tuple)) and part.isdigit() and int(part) < len(at):
                at = at[int(part)]
            else:
                return f"<missing:{path}>"
        if isinstance(at, (Mapping, list, tuple)):
            return json.dumps(at, ensure_ascii=False, indent=2)
        return "<none>" if at is None else str(at)

    return re.sub(r"\\\{\{|\{\{\s*([^}]+?)\s*\}\}", resolve, template)


def pivot_markdown(title: str, cells: DataFrame) -> str:
    """A pivot with totals as a Markdown table: count and share of its row in percent; rows of
    fewer than ten users are flagged."""
    rows = cells.collect()  # labels by labels
    columns = sorted({r["col_label"] for r in rows} - {"(all)"}) + ["(all)"]
    by = {(r["row_label"], r["col_label"]): r for r in rows}
    names = sorted({r["row_label"] for r in rows} - {"(all)"}) + ["(all)"]
    out = [f"### {title}", "", "| | " + " | ".join(columns) + " |", "|---" * (len(columns) + 1) + "|"]
    for name in names:
        shown = []
        for c in columns:
            r = by.get((name, c))
            shown.append("0" if r is None else str(r["n"]) if c == "(all)" else f"{r['n']} ({r['row_pct']:.0f}%)")
        total = by.get((name, "(all)"))
        flag = " ⚠ N<10" if total is not None and total["small"] else ""
        out.append(f"| {name}{flag} | " + " | ".join(shown) + " |")
    return "\n".join(out) + "\n"


def signed(old: float, new: float) -> str:
    """the change with its sign."""
    d = new - old
    return f"{_plain(d):+}" if d else "0"


def percent(old: float, new: float) -> str:
    """the change in percent; new from nothing, a dash for none."""
    return "—" if old == new == 0 else "new" if old == 0 else f"{(new - old) / old * 100:+.0f}%"


def difference_text(changes: DataFrame) -> str:
    """Changed counters by category, largest new value first, then by name."""
    out, last = [], None
    for r in sorted(changes.collect(), key=lambda r: (r["category"], -r["new_value"], r["key"])):
        if r["category"] != last:
            last = r["category"]
            out.append(f"{last}:")
        o, n = _plain(r["old_value"]), _plain(r["new_value"])
        out.append(f"  {r['key']}: {o} -> {n} ({signed(o, n)}, {percent(o, n)}) [{r['status']}]")
    return "\n".join(out) + ("\n" if out else "no changes\n")


def ensure_salt(path: str | Path) -> str:
    """The salt of the file, made and kept for its owner alone if there is none."""
    target = Path(path)
    if target.exists():
        return target.read_text(encoding="utf-8").strip()
    target.parent.mkdir(parents=True, exist_ok=True)
    salt = secrets.token_hex(32)
    handle = os.open(target, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o600)
    with os.fdopen(handle, "w") as f:
        f.write(salt)
    return salt


def scaffold(folder: str | Path) -> list[str]:
    """A project folder: places for exports and results, a salt, ignored files, a note. What is there stays."""
    root, made = Path(folder), []
    for name in ("exports", "out", "config"):
        (root / name).mkdir(parents=True, exist_ok=True)
    for name, text in ((".gitignore", "out/\nexports/\n.salt\n"), ("README.md", "Exports go to exports/, results to out/.\n"), ("config/report.md", "Messages: {{stats.metadata.total_messages}}\n")):
        if not (root / name).exists():
            (root / name).write_text(text, encoding="utf-8")
            made.append(name)
    if not (root / ".salt").exists():
        ensure_salt(root / ".salt")
        made.append(".salt")
    return made
