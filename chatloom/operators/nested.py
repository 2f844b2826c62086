"""Flat, linked tables from deeply nested JSON records (p5), by shared inlining.

The schema graph is read from the data: each task notes the different paths and kinds of value it
meets, and these sets are united. A place may hold several kinds (an object here, text there); each
is followed. Elements of the graph are named by their key (elements of an array by the array's), so
that the same element under several parents is one node. An element that occurs at most once below
one parent alone is inlined: its scalars are columns of the nearest table above. An element that
repeats (an array's), is shared (several parents) or recurs (below itself) gets a table of its own.
A table's rows are identified by the record key, the path and the positions along it, so a child's
foreign key is a prefix of its own key and no join or shuffle is needed to fill it.

Texts up to LARGE bytes are read as VARIANT in the JVM; larger ones, which a VARIANT may not hold, are
taken apart element by element in Arrow batches, with the same rows as result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.jsonstream import LARGE, Reading, head_of, scalar_text

Path = tuple[str, ...]


@dataclass
class Node:
    """A place of the schema graph."""

    kinds: set[str] = field(default_factory=set)  #: of object, array, scalar
    children: dict[str, "Node"] = field(default_factory=dict)  #: by key; an array's element under "[]"


def build_graph(found: Iterable[tuple[Sequence[str], str]]) -> Node:
    """The graph of (path, kind) pairs; paths are object keys with "[]" for array elements."""
    root = Node()
    for path, kind in sorted((tuple(p), k) for p, k in found):
        at = root
        for step_ in path:
            at = at.children.setdefault(step_, Node())
        at.kinds.add(kind)
    return root


def whole_json(payload: Column) -> Column:
    """The payload as VARIANT if all of it is one JSON value, else NULL.

    The parser stops after the first value; inside brackets, anything after it makes the text invalid.
    A text too large to tell broken from too large for a VARIANT is refused with an error, never lost.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    items = boxed.cast("array<variant>")
    lost = boxed.isNull() & (F.octet_length(payload) > LARGE)
    refusal = F.raise_error(F.concat(F.lit("a JSON value of "), F.octet_length(payload).cast("string"), F.lit(" bytes is broken or too large for a VARIANT"))).cast("variant")
    return F.when(lost, refusal).when(F.size(items) == 1, items[0])


def step(name: str) -> str | None:
    """A path step in the syntax of variant_get; None for a key that it can't express."""
    if "?" not in name and name:
        for quote in "'\"":
            if quote not in name:
                return f"[{quote}{name}{quote}]"
    return f".{name}" if name and not set(name) & set(".[") else None


def reach(value: Column, steps: Path, kind: str = "variant") -> Column:
    """What stands at steps below a VARIANT, as another type; NULL if nothing does or it has another form."""
    path = "$"
    for name in steps:
        if (at := step(name)) is None:
            value, path = F.try_element_at(F.try_variant_get(value, path, "map<string,variant>"), F.lit(name)), "$"
        else:
            path += at
    return F.try_variant_get(value, path, kind)


@dataclass
class Place:
    """Where rows of a table come from."""

    path: Path
    parent: Path | None  #: path of the place whose rows are the parents; None for the topmost
    cells: dict[str, tuple[Path, str]]  #: column -> (steps below the place, what is taken: scalar or size)
    others: set[Path] = field(default_factory=set)  #: steps below the place at which objects or arrays occur


@dataclass
class Table:
    """One table of the inlining."""

    name: str
    places: list[Place] = field(default_factory=list)
    recursive: bool = False

    def columns(self) -> dict[str, str]:
        """Columns by their lower-case names; keys that differ only in case share one."""
        out: dict[str, str] = {}
        for place in self.places:
            for column in place.cells:
                out.setdefault(column.lower(), column)
        return out


def column_name(steps: Path) -> str:
    """The column of an inlined descendant: its keys joined by full stops; `$` for the element itself."""
    return ".".join(s.replace("\\", "\\\\").replace(".", "\\.") for s in steps) or "$"


def _walk(node: Node, at: Path, label: str, names: Mapping[Path, str]):
    """(parent element, element, path, node, kind) of every object and array below a node."""
    for key, child in node.children.items():
        here = (*at, key)
        inner = names.get(at, label) if key == "[]" else names.get(here, key)
        for kind in ("object", "array"):
            if kind in child.kinds:
                yield label, inner, here, child, kind
        yield from _walk(child, here, inner, names)


def inline(graph: Node, names: Mapping[Path, str] | None = None) -> dict[str, Table]:
    """Tables of a schema graph, by element.

    Elements with the same name share a table whatever parent they stand under; `names` renames the
    element at a path, so that several containers of the same element can be put together.
    """
    names = names or {}
    above: dict[str, set[str]] = defaultdict(set)
    tabled = {"record"}
    for parent, label, path, _, kind in _walk(graph, (), "record", names):
        if kind == "array" or path[-1] == "[]":
            tabled.add(label)
        else:
            above[label].add(parent)
    tabled |= {label for label, parents in above.items() if len(parents) > 1}
    for label in list(above):  # below itself, however many elements lie between
        seen, todo = set(), set(above[label])
        while todo - seen:
            one = (todo - seen).pop()
            seen.add(one)
            todo |= above.get(one, set())
        if label in seen:
            tabled.add(label)
    tables: dict[str, Table] = {}

    def table_at(node: Node, path: Path, label: str, parent: Path | None, chain: tuple[str, ...]) -> None:
        """The rows at a path: objects and scalars there; then what has tables below it."""
        target = tables.setdefault(label, Table(label))
        target.recursive |= label in chain
        place = Place(path, parent, {})
        if path and path[-1] == "[]" and "scalar" in node.kinds:
            place.cells["$"] = ((), "scalar")
        if path and path[-1] == "[]" and node.kinds - {"scalar"}:
            place.others.add(())
        if path and path[-1] == "[]" and node.kinds or "object" in node.kinds:
            target.places.append(place)
        fill(node, place, (), path, label, (*chain, label))
        if "array" in node.kinds and path and path[-1] == "[]":  # an array right within an array
            array_at(node, path, label + "_item", path, (*chain, label))

    def array_at(node: Node, path: Path, label: str, parent: Path | None, chain: tuple[str, ...]) -> None:
        table_at(node.children.get("[]", Node()), (*path, "[]"), label, parent, chain)

    def fill(node: Node, place: Place, below: Path, path: Path, label: str, chain: tuple[str, ...]) -> None:
        for key, child in node.children.items():
            if key == "[]":
                continue
            here, steps = (*path, key), (*below, key)
            name = names.get(here, key)
            if "scalar" in child.kinds:
                place.cells[column_name(steps)] = (steps, "scalar")
            if child.kinds - {"scalar"}:
                place.others.add(steps)
            if "object" in child.kinds:
                if name in tabled:
                    table_at(Node({"object"}, {k: v for k, v in child.children.items() if k != "[]"}), here, name, place.path, chain)
                else:
                    fill(Node({"object"}, {k: v for k, v in child.children.items() if k != "[]"}), place, steps, here, name, chain)
            if "array" in child.kinds:
                place.cells[column_name(steps) + "[]"] = (steps, "size")
                array_at(child, here, name, place.path, chain)

    if "array" in graph.kinds:
        array_at(graph, (), names.get((), "record"), None, ())
    if "object" in graph.kinds:
        table_at(Node({"object"}, {k: v for k, v in graph.children.items() if k != "[]"}), (), "record", None, ())
    return tables


def schema_graph(df: DataFrame, payload: str, most: int = 100_000) -> Node:
    """The schema graph of a JSON text column; without children for an empty table or one without JSON.

    All rows are read, large texts element by element. More than `most` different paths (data used as
    keys) are refused rather than made into columns.
    """

    def paths(batches):
        import json

        import pyarrow as pa

        met: set[tuple[Path, str]] = set()

        def walk(value, at: Path) -> None:
            if isinstance(value, dict):
                met.add((at, "object"))
                for k, v in value.items():
                    walk(v, at + (k,))
            elif isinstance(value, list):
                met.add((at, "array"))
                for v in value:
                    walk(v, at + ("[]",))
            else:
                met.add((at, "scalar"))

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                try:
                    if text is not None and len(text) > LARGE:
                        walk(head_of(text), ())
                        for path, _, value, _, _ in Reading(text).elements():
                            walk(value, (*path, "[]"))
                    else:
                        walk(json.loads(text), ())
                except (TypeError, ValueError, RecursionError):
                    continue
        rows = list(met)
        yield pa.RecordBatch.from_arrays([pa.array([list(p) for p, _ in rows], pa.list_(pa.string())), pa.array([k for _, k in rows], pa.string())], names=["p", "k"])

    found = df.select(payload).mapInArrow(paths, "p array<string>, k string").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} different paths")
    return build_graph((r["p"], r["k"]) for r in found)


def path_text(path: Path | None) -> str | None:
    """A path as shown in tables: `$.a[].b`."""
    return None if path is None else "$" + "".join(p if p == "[]" else "." + p for p in path)


def _cell(steps: Path, taken: str, mixed: bool) -> Column:
    """The scalar (`mixed`: among other kinds), or the number of elements, at steps below `_v` as text."""
    value = F.col("_v")
    if taken == "size":
        return F.size(reach(value, steps, "array<variant>")).cast("string")
    text = reach(value, steps, "string")
    return F.when(~F.schema_of_variant(reach(value, steps)).rlike("^(OBJECT|ARRAY|VOID)"), text) if mixed else text


def _cells(places: Sequence[Place], columns: Iterable[str], before: Path, strict: bool) -> list[Column]:
    """The named columns (lower case) of any of some places; `before` are steps from `_v` down to them.

    The graph knows all places, so what only one of them has is null in the others' rows.
    """
    by: dict[str, dict[tuple[Path, str], None]] = defaultdict(dict)
    for place in places:
        for column, told in place.cells.items():
            by[column.lower()][told] = None
    others = {steps for place in places for steps in place.others}
    return [F.coalesce(*[_cell((*before, *steps), taken, strict or steps in others) for steps, taken in by[c]]) if c in by else F.lit(None).cast("string") for c in columns]


def _shape(place: Place) -> tuple:
    """Places of one shape, which differ only before their first array, are read in one scan."""
    first = place.path.index("[]") if "[]" in place.path else None
    return (place.path, 0) if first is None else (place.path[first:], len(place.path) - len(place.parent) if place.parent is not None else -1)


def _small(source: DataFrame, places: Mapping[Path, Place], group: list[Place], own: list[str], parents: list[str], strict: bool) -> DataFrame:
    """Rows of places of one shape in (`_k`, `_v`): `_k`, `_g` the place's number, `_p` positions, cells
    `_c` of own columns and `_h` of the parent's."""
    none = F.array().cast("array<string>")
    above = [places[p.parent] for p in group if p.parent is not None]
    inherited = lambda pending: F.array(*_cells(above, parents, pending, strict))
    rows = source.select("_k", F.lit(0).alias("_g"), F.array().cast("array<int>").alias("_p"), none.alias("_h"), "_v")
    path = group[0].path
    first = path.index("[]") if "[]" in path else len(path)
    lifted = group[0].parent is not None and len(group[0].parent) or 0
    if parents and above and lifted <= first:
        rows = rows.withColumn("_h", F.coalesce(*[F.when(reach(F.col("_v"), p.path).isNotNull(), F.array(*_cells([p], parents, p.path, strict))) for p in above], none))
    pending: Path = path[:first]
    if first < len(path):
        boxes = F.filter(F.array(*[F.struct(F.lit(g).alias("g"), reach(F.col("_v"), p.path[: p.path.index("[]")], "array<variant>").alias("items")) for g, p in enumerate(group)]), lambda b: b["items"].isNotNull())
        rows = rows.select("_k", "_h", F.explode(boxes).alias("_b"))
        rows = rows.select("_k", F.col("_b.g").alias("_g"), "_h", F.posexplode("_b.items").alias("_i", "_v")).select("_k", "_g", F.array("_i").alias("_p"), "_h", "_v")
        pending = ()
    for k in range(first + 1, len(path) + 1):
        if parents and above and k == lifted:
            rows = rows.withColumn("_h", inherited(pending))
        if k == len(path):
            break
        if path[k] != "[]":
            pending += (path[k],)
            continue
        array = reach(F.col("_v"), pending, "array<variant>")
        rows = rows.select("_k", "_g", "_p", "_h", F.posexplode(array).alias("_i", "_w")).select("_k", "_g", F.concat("_p", F.array("_i")).alias("_p"), "_h", F.col("_w").alias("_v"))
        pending = ()
    if pending or not path:  # one object at most below each parent
        rows = rows.where(F.coalesce(F.schema_of_variant(reach(F.col("_v"), pending)).startswith("OBJECT"), F.lit(False)))
    return rows.select("_k", "_g", "_p", "_h", F.array(*_cells(group, own, pending, strict)).alias("_c") if own else none.alias("_c"))


def _large(source: DataFrame, kind: str, places: Mapping[Path, Place], group: list[Place], own: list[str], parents: list[str]) -> DataFrame:
    """The same rows of the texts in (`_k`, `_t`), read element by element."""
    openings = {p.path[: p.path.index("[]")] for p in group if "[]" in p.path}

    def pick(value, at: Place | None, columns: list[str]) -> list[str | None]:
        out: dict[str, str] = {}
        for column, (steps, taken) in at.cells.items() if at is not None else ():
            found = value
            for s in steps:
                found = found.get(s) if isinstance(found, dict) else None
            if (text := (str(len(found)) if isinstance(found, list) else None) if taken == "size" else scalar_text(found)) is not None:
                out.setdefault(column.lower(), text)
        return [out.get(c) for c in columns]

    def below(place: Place, value, k: int, positions: list[int], held: list):
        """From a value at the first k pieces of the path to the rows of the place."""
        if parents and place.parent is not None and k == len(place.parent):
            held = pick(value, places[place.parent], parents)
        if k == len(place.path):
            if k and place.path[-1] == "[]" or isinstance(value, dict):
                yield positions, held, pick(value, place, own)
        elif place.path[k] == "[]":
            for i, v in enumerate(value if isinstance(value, list) else ()):
                yield from below(place, v, k + 1, [*positions, i], held)
        elif isinstance(value, dict) and place.path[k] in value:
            yield from below(place, value[place.path[k]], k + 1, positions, held)

    def rows_of(text: str):
        try:
            head = head_of(text, openings)
        except ValueError:
            return
        held: dict[int, list] = {}
        for g, place in enumerate(group):
            if "[]" not in place.path:
                for row in below(place, head, 0, [], []):
                    yield g, *row
            elif parents and place.parent is not None and "[]" not in place.parent:
                value = head
                for piece in place.parent:
                    value = value.get(piece) if isinstance(value, dict) else None
                held[g] = pick(value, places[place.parent], parents)
        if openings:
            for path, position, value, _, _ in Reading(text, openings).elements():
                for g, place in enumerate(group):
                    if place.path[: len(path) + 1] == (*path, "[]"):
                        for row in below(place, value, len(path) + 1, [position], held.get(g, [])):
                            yield g, *row

    def run(batches):
        import pyarrow as pa

        texts = pa.list_(pa.string())

        def handed(key, rows):
            columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.list_(pa.int32()), texts, texts))]
            return pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(rows), key.type), *columns], names=["_k", "_g", "_p", "_h", "_c"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                rows: list = []
                for row in rows_of(text.as_py()):
                    rows.append(row)
                    if len(rows) == 5_000:
                        yield handed(key, rows)
                        rows = []
                if rows:
                    yield handed(key, rows)

    return source.mapInArrow(run, f"_k {kind}, _g int, _p array<int>, _h array<string>, _c array<string>")


def shred(
    df: DataFrame, key: str, payload: str, graph: Node | None = None, names: Mapping[Path, str] | None = None, inherit: Mapping[str, Sequence[str]] | None = None, large: int = LARGE
) -> dict[str, DataFrame]:
    """Flat tables of a column of JSON texts, by element name.

    Each table has `key` (the record), `path` (where the element stood), `keys` (positions along the
    path; with the two before the row's identity), `parent_path` and `parent_keys` (with the record
    the foreign key, the identity of the parent's row) and one STRING column per inlined descendant,
    named by its keys joined by full stops (`$` for an element that is a scalar itself; with `[]` behind it the number of elements of an array, whose rows are in a table of their own). `inherit`
    names, by element, columns of the parents to be carried along as `parent.<column>`, which
    resolves the foreign key while the parent is at hand, without a join.

    Texts that aren't one JSON value and null ones give no rows. `graph` may be given to keep the
    schema fixed over runs; it is read from all rows otherwise. Where a place holds an object or array in one record and a
    scalar in another, its column has the scalar. Object keys that differ only in case share a column. Columns
    that clash with the five above get a trailing underscore. Texts of more than `large` bytes are read element by element.
    """
    strict = graph is not None
    graph = schema_graph(df, payload) if graph is None else graph
    picked = df.select(F.col(key).alias("_k"), F.col(payload).alias("_t")).where(F.col("_t").isNotNull())
    small = picked.where(F.octet_length("_t") <= large).select("_k", whole_json(F.col("_t")).alias("_v")).where(F.col("_v").isNotNull())
    big = picked.where(F.octet_length("_t") > large)
    kind = df.schema[key].dataType.simpleString()
    tables = inline(graph, names)
    places = {place.path: place for spec in tables.values() for place in spec.places}
    out: dict[str, DataFrame] = {}
    for name, spec in tables.items():
        columns = spec.columns()
        own, parents = list(columns), [c.lower() for c in (inherit or {}).get(name, ())]
        groups: dict[tuple, list[Place]] = defaultdict(list)
        for place in spec.places:
            groups[_shape(place)].append(place)
        part = None
        for group in groups.values():
            rows = _small(small, places, group, own, parents, strict).unionByName(_large(big, kind, places, group, own, parents))
            n = 0 if group[0].parent is None else group[0].parent.count("[]")
            taken = {key.lower(), "path", "keys", "parent_path", "parent_keys"}
            shown = lambda paths: F.array(*[F.lit(path_text(p)).cast("string") for p in paths])[F.col("_g")]
            flat = rows.select(
                F.col("_k").alias(key), shown([p.path for p in group]).alias("path"), F.col("_p").alias("keys"), shown([p.parent for p in group]).alias("parent_path"),
                F.slice("_p", 1, n).alias("parent_keys") if n else F.array().cast("array<int>").alias("parent_keys"),
                *[F.col("_c")[k].alias(columns[c] + "_" if c in taken else columns[c]) for k, c in enumerate(own)],
                *[F.try_element_at("_h", F.lit(k + 1)).alias(f"parent.{c}") for k, c in enumerate(parents)],
            )
            part = flat if part is None else part.unionByName(flat)
        if part is not None:
            out[name] = part
    return out


# --- the chat exports ---------------------------------------------------------------------------

# Where the known export shapes keep their messages, and the columns (after inlining)
# in which each shape has the fields of a message. Of several the first that isn't empty counts.
CONTAINERS = {(): "messages", ("messages",): "messages", ("data", "messages"): "messages", ("data", "items"): "messages"}
MESSAGE_ID = ("message_id", "id", "ts")
AUTHOR_ID = ("author_id", "from_id", "user", "author.id", "sender.sender_id.open_id", "sender.sender_id.user_id", "sender.id")
AUTHOR_NAME = ("author_name", "author.nickname", "author.name", "from", "user_profile.display_name", "user_profile.real_name", "sender.name")
SENT_AT = ("timestamp", "ts", "date", "create_time")
REPLY_TO = ("reply_to_message_id", "reference.messageId", "thread_ts", "parent_id")
EMOJI = ("emoji.name", "emoji", "name", "reaction_type.emoji_type", "$")


def first_of(df: DataFrame, columns: Sequence[str], prefix: str = "") -> Column:
    """The first of the columns that isn't empty; columns that the schema doesn't have are null."""
    there = {c.lower(): c for c in df.columns}
    found = [F.nullif(F.col(f"`{there[low]}`"), F.lit("")) for c in columns if (low := (prefix + c).lower()) in there]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def chat_tables(records: DataFrame, key: str = "record_id", payload: str = "payload", graph: Node | None = None) -> dict[str, DataFrame]:
    """The shredded tables `messages` and `reactions` of chat exports, each with its links.

    `messages` has a row per element of a known container; `reactions` one per entry of an array of
    that name wherever it stands, with the id and author columns of the element that holds it. A name that
    no record uses gives an empty table.
    """
    parents = [*MESSAGE_ID, *AUTHOR_ID]
    tables = shred(records, key, payload, graph, names=CONTAINERS, inherit={"reactions": parents})
    none = records.sparkSession.createDataFrame([], f"`{key}` {records.schema[key].dataType.simpleString()}, path string, keys array<int>, parent_path string, parent_keys array<int>")
    return {name: tables.get(name, none) for name in ("messages", "reactions")}


def message_table(tables: Mapping[str, DataFrame], key: str = "record_id") -> DataFrame:
    """One row per message: `key`, `container`, `message_pos`, message_id, author_key, author_name,
    sent_at, reply_to; from the shredded `messages`. Elements that aren't objects give no row."""
    rows = tables["messages"]
    if "$" in rows.columns:
        rows = rows.where(F.col("`$`").isNull())
    return rows.select(
        key, F.regexp_replace("path", r"\[\]$", "").alias("container"), F.element_at("keys", -1).cast("bigint").alias("message_pos"),
        first_of(rows, MESSAGE_ID).alias("message_id"), F.coalesce(first_of(rows, AUTHOR_ID), F.lit("")).alias("author_key"), first_of(rows, AUTHOR_NAME).alias("author_name"),
        first_of(rows, SENT_AT).alias("sent_at"), first_of(rows, REPLY_TO).alias("reply_to"),
    )


def reaction_table(tables: Mapping[str, DataFrame], key: str = "record_id") -> DataFrame:
    """One row per entry of a message's `reactions` array: `key`, `container`, `message_pos`,
    `reaction_pos`, `message_id`, `author_key`, `emoji` (NULL without a name) and `n`: the count as
    written, else the number of users or operators listed.

    From the shredded `reactions`, of which only those below an element of an array are a message's.
    """
    rows = tables["reactions"].where(F.size("keys") >= 2)
    written = first_of(rows, ("count", "cnt"))
    return rows.select(
        key, F.regexp_replace("parent_path", r"\[\]$", "").alias("container"), F.element_at("keys", -2).cast("bigint").alias("message_pos"), F.element_at("keys", -1).cast("bigint").alias("reaction_pos"),
        first_of(rows, MESSAGE_ID, "parent.").alias("message_id"), F.coalesce(first_of(rows, AUTHOR_ID, "parent."), F.lit("")).alias("author_key"), first_of(rows, EMOJI).alias("emoji"),
        F.coalesce(written.try_cast("bigint"), first_of(rows, ("users[]", "operators[]")).try_cast("bigint")).alias("n"),
    )


def author_table(messages: DataFrame) -> DataFrame:
    """One row per author id met in the messages: `author_key`, `author_name` (the smallest
    non-empty one), `n_messages`. However often it is nested, an author is stored once."""
    return messages.where(F.col("author_key") != "").groupBy("author_key").agg(F.min("author_name").alias("author_name"), F.count(F.lit(1)).alias("n_messages"))


def cell_rows(tables: Mapping[str, DataFrame], key: str) -> DataFrame | None:
    """All cells of shredded tables in one long table: `key`, `path`, `keys` (joined by commas),
    `parent_path`, `parent_keys`, `column`, `value`; nulls left out. None without tables."""
    out = None
    for df in tables.values():
        links = (key, "path", "keys", "parent_path", "parent_keys")
        names = [c for c in df.columns if c not in links and not c.startswith("parent.") and not c.endswith("[]")]
        if not names:
            continue
        cells = F.explode(F.filter(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in names]), lambda x: x["value"].isNotNull())).alias("x")
        joined = lambda c: F.array_join(F.transform(c, lambda i: i.cast("string")), ",").alias(c)
        part = df.select(key, "path", joined("keys"), "parent_path", joined("parent_keys"), cells).select(key, "path", "keys", "parent_path", "parent_keys", "x.column", "x.value")
        out = part if out is None else out.unionByName(part)
    return out
