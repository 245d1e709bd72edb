"""Schemas that drift between the files of a feed.

File headers (which fields a file has, with the types of their non-null values) are read in parallel, folded
through a type-promotion lattice into one schema per feed, files are cast to it, and the ordered differences
between consecutive files are logged.

Bodies are parsed once for the headers, which are combined map-side; only the records of files in which a field
comes while another goes are read again for their values, and of these only the fields in question.

Defined results
---------------
* a null, cut or otherwise invalid body is ignored, as is a valid body that is no object; a file with
  no valid record has no header and is passed over;
* rows with a null feed or file number are left out; an empty input gives empty results;
* a record delivered twice in a file counts once (the last delivered one, then the last line);
* several JSON types in one file: the most frequent one, then the first by name;
* a renamed field keeps its last known type under its new name; two fields that end under one name keep apart, the one
  seen last has the name, the others are named ``name@origin``;
* a value that does not fit the union type is null in the typed table (there is none: the type is a bound of all values).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.sources.tables import cut_lineage

#: JSON types in the order that decides between equally frequent ones.
KINDS = ("boolean", "number", "string", "list", "object")
#: Chains of the lattice: a type goes up its chain to the first that holds all values; beyond a chain it is ``string``.
CHAINS = (("integer", "decimal", "double"), ("date", "timestamp"))
DATE = r"^\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])$"
TIMESTAMP = r"^\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])[T ](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?$"
#: Most changing files (some names each) that are sent to every executor.
BROADCAST_FILES = 100_000
#: Types of the lattice as they stand in a table.
SQL_TYPES = {"integer": "bigint", "decimal": "decimal(38,10)", "double": "double", "date": "date", "timestamp": "timestamp_ntz", "boolean": "boolean", "string": "string", "object": "variant"}


def json_kind(schema: Column) -> Column:
    """JSON type name of a variant's schema string; null for a JSON null."""
    head = F.regexp_extract(schema, "^[A-Z]+", 0)
    return (
        F.when(head == "VOID", F.lit(None).cast("string"))
        .when(head == "STRING", "string")
        .when(head == "BOOLEAN", "boolean")
        .when(head == "ARRAY", "list")
        .when(head == "OBJECT", "object")
        .otherwise("number")
    )


def scalar_type(schema: Column, text: Column) -> Column:
    """Lattice type of a scalar by its variant schema; of a string by its ``text``."""
    head = F.regexp_extract(schema, "^[A-Z]+", 0)
    dated = F.when(text.rlike(DATE), "date").when(text.rlike(TIMESTAMP), "timestamp").otherwise("string")
    return (
        F.when(head == "VOID", F.lit(None).cast("string"))
        .when(head == "STRING", dated)
        .when(head == "BOOLEAN", "boolean")
        .when(head == "BIGINT", "integer")
        .when(head == "DECIMAL", "decimal")
        .when(head == "OBJECT", "object")
        .when(head == "ARRAY", "string")
        .otherwise("double")
    )


def lattice_type(value: Column, schema: Column) -> Column:
    """Lattice type of a variant of that schema: a scalar's, or ``list<t>`` of the join of its elements' types; null for a JSON null."""
    items = F.try_variant_get(value, "$", "array<variant>")
    each = F.transform(items, lambda v: scalar_type(F.schema_of_variant(v), F.try_variant_get(v, "$", "string")))
    return F.when(schema.startswith("ARRAY"), F.concat(F.lit("list<"), promote_scalars(each), F.lit(">"))).otherwise(
        scalar_type(schema, F.try_variant_get(value, "$", "string"))
    )


def promote_scalars(kinds: Column) -> Column:
    """Least upper bound of an array of scalar types; of none it is ``string``."""

    def bound(known: Column) -> Column:
        out = F.when(F.size(known) == 0, F.lit("string")).when(F.size(known) == 1, F.get(known, F.lit(0)))
        for chain in CHAINS:
            top = F.lit(chain[0])
            for k in chain[1:]:
                top = F.when(F.array_contains(known, k), k).otherwise(top)
            out = out.when(F.size(F.array_except(known, F.array(*[F.lit(k) for k in chain]))) == 0, top)
        return out.otherwise("string")

    return F.get(F.transform(F.array(F.array_distinct(F.array_compact(kinds))), bound), F.lit(0))


def promote(kinds: Column) -> Column:
    """Least upper bound of an array of lattice types: lists join by element, a list and a scalar at ``string``."""
    known = F.array_compact(kinds)
    lists = F.filter(known, lambda k: k.startswith("list<"))
    inside = F.transform(lists, lambda k: F.regexp_extract(k, "^list<(.*)>$", 1))
    whole = (F.size(known) > 0) & (F.size(lists) == F.size(known))
    return F.when(whole, F.concat(F.lit("list<"), promote_scalars(inside), F.lit(">"))).otherwise(promote_scalars(known))


def records(raw: DataFrame, keys: tuple[str, ...] = ("ITEM", "id")) -> DataFrame:
    """Valid records ``(feed, file_no, rec_id, line_no, delivered_at, rec_key, body)``, ``body`` as a variant."""
    placed = raw.where(F.col("feed").isNotNull() & F.col("file_no").isNotNull() & F.ltrim("body", F.lit(" \t\n\r")).startswith("{"))
    valid = placed.withColumn("_v", F.try_parse_json("body")).where(F.col("_v").isNotNull())
    rec_key = F.coalesce(*[F.try_variant_get("_v", f"$.{k}", "string") for k in keys])
    return valid.select("feed", "file_no", "rec_id", "line_no", "delivered_at", rec_key.alias("rec_key"), F.col("_v").alias("body"))


def fields_of(body: Column) -> Column:
    """Fields of an object as an array of ``(key, value)``, values as variants."""
    return F.map_entries(F.try_variant_get(body, "$", "map<string,variant>"))


def headers(recs: DataFrame, types: bool = True) -> DataFrame:
    """``(feed, file_no, field, kind, types)``: the fields of each file, their JSON type and, if asked for, their lattice types.

    Combined map-side, so hot feeds stay small.
    """
    flat = recs.select("feed", "file_no", F.explode(fields_of(F.col("body"))).alias("e"))
    seen = flat.select("feed", "file_no", F.col("e.key").alias("field"), F.schema_of_variant("e.value").alias("_s"), F.col("e.value").alias("_v"))
    type_ = lattice_type(F.col("_v"), F.col("_s")) if types else F.lit(None).cast("string")
    told = seen.select("feed", "file_no", "field", json_kind(F.col("_s")).alias("kind"), type_.alias("type"))
    counted = told.groupBy("feed", "file_no", "field", "kind", "type").agg(F.count("*").alias("n"))
    by_kind = counted.groupBy("feed", "file_no", "field", "kind").agg(F.sum("n").alias("n"), F.collect_set("type").alias("types"))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    best = F.max(F.when(F.col("kind").isNotNull(), F.struct("n", (-rank).alias("o"), "kind")))
    every = F.array_distinct(F.flatten(F.collect_list("types")))
    return by_kind.groupBy("feed", "file_no", "field").agg(best.alias("b"), every.alias("types")).select("feed", "file_no", "field", "b.kind", "types")


def files_of(header: DataFrame) -> DataFrame:
    """``(feed, file_no, prev_no, came, went)`` of the files in which fields come while others go against the file before."""
    held = header.groupBy("feed", "file_no").agg(F.collect_set("field").alias("now"))
    order = W.partitionBy("feed").orderBy("file_no")
    both = held.select("feed", "file_no", "now", F.lag("file_no").over(order).alias("prev_no"), F.lag("now").over(order).alias("before"))
    told = both.where("prev_no IS NOT NULL").select("feed", "file_no", "prev_no", F.array_except("now", "before").alias("came"), F.array_except("before", "now").alias("went"))
    return told.where((F.size("came") > 0) & (F.size("went") > 0))


def renames(recs: DataFrame, header: DataFrame, share: float = 0.8) -> DataFrame:
    """``(feed, file_no, old, field)``: a field that goes while another comes with the same values.

    Only the values of fields that come or go are compared, record by record; a pair stands if it is
    the best of both its fields (then the first by name).
    """
    changed = cut_lineage(files_of(header))
    part = lambda at, names, role: changed.select("feed", F.col(at).alias("file_no"), F.struct(F.col("file_no").alias("to"), F.col(names).alias("names"), F.lit(role).alias("role")).alias("p"))
    parts = part("prev_no", "went", 0).unionByName(part("file_no", "came", 1)).groupBy("feed", "file_no").agg(F.collect_list("p").alias("parts"))
    if changed.count() <= BROADCAST_FILES:  # beyond it, records are exchanged by file
        parts = F.broadcast(parts)
    keyed = recs.where(F.col("rec_key").isNotNull()).join(parts, ["feed", "file_no"])
    each_part = keyed.select("feed", "rec_key", "delivered_at", "line_no", "rec_id", "body", F.explode("parts").alias("p"))
    cells_of = F.transform(
        F.filter(fields_of(F.col("body")), lambda e: F.array_contains(F.col("p.names"), e["key"])),
        lambda e: F.struct(e["key"].alias("f"), F.when(F.schema_of_variant(e["value"]) != "VOID", F.xxhash64(F.to_json(e["value"]))).alias("h")),
    )
    placed = each_part.select("feed", F.col("p.to").alias("file_no"), "rec_key", F.col("p.role").alias("role"), F.struct("delivered_at", "line_no", "rec_id", cells_of.alias("cells")).alias("r"))
    last = lambda role: F.max(F.when(F.col("role") == role, F.col("r")))
    met = placed.groupBy("feed", "file_no", "rec_key").agg(last(0).alias("o"), last(1).alias("n")).where("o IS NOT NULL AND n IS NOT NULL")
    both = met.select("feed", "file_no", F.col("o.cells").alias("went"), F.col("n.cells").alias("came"))
    was = F.filter("went", lambda o: o["h"].isNotNull())
    said = changed.select("feed", "file_no", F.col("came").alias("_came"))
    met = both.select("feed", "file_no", "came", F.explode(was).alias("o")).join(said, ["feed", "file_no"])
    each = met.select("feed", "file_no", "o", "came", F.explode("_came").alias("field"))
    equal = F.exists("came", lambda n: (n["f"] == F.col("field")) & (n["h"] == F.col("o.h")))
    compared = each.groupBy("feed", "file_no", F.col("o.f").alias("old"), "field").agg(F.avg(F.coalesce(equal, F.lit(False)).cast("double")).alias("equal")).where(F.col("equal") >= share)
    best_old = W.partitionBy("feed", "file_no", "old").orderBy(F.desc("equal"), "field")
    best_new = W.partitionBy("feed", "file_no", "field").orderBy(F.desc("equal"), "old")
    ranked = compared.select("*", F.row_number().over(best_old).alias("_o"), F.row_number().over(best_new).alias("_n"))
    return ranked.where("_o = 1 AND _n = 1").select("feed", "file_no", "old", "field")


LINEAGE = "feed string, file_no int, change string, field string, kind string, lineage string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold headers in order of feed and file; state is one feed's fields, whatever the number of records."""
    out: dict[str, list] = {c: [] for c in ("feed", "file_no", "change", "field", "kind", "lineage")}
    state: dict = {"feed": None}
    file: dict = {}

    def close() -> None:
        if not file:
            return
        feed, no, now = file["feed"], file["no"], file["fields"]
        prev, types, roots, first = state["prev"], state["types"], state["roots"], state["first"]
        emit = lambda change, f, kind, root: [out[c].append(v) for c, v in zip(out, (feed, no, change, f, kind, root), strict=True)]
        renamed = {old: f for f, (_, old) in now.items() if old is not None}
        moved = {f: (types.pop(old, None), roots.pop(old)) for old, f in renamed.items()}
        for f, (known, root) in moved.items():
            types.pop(f, None)
            roots[f] = root
            if known is not None:
                types[f] = known
            emit("renamed", f, None, None)
        for f in sorted(now):
            if f not in prev and f not in moved:
                roots.setdefault(f, f"{no}:{f}")
                if not first:
                    emit("added", f, None, None)
        for f in sorted(prev - now.keys() - renamed.keys()):
            emit("removed", f, None, None)
        for f, (kind, _) in sorted(now.items()):
            if kind is not None:
                if types.get(f, kind) != kind:
                    emit("retyped", f, None, None)
                types[f] = kind
            emit(None, f, kind, roots[f])
        state.update(prev=set(now), first=False)

    for batch in batches:
        for row in batch.to_pylist():
            if file and (row["feed"], row["file_no"]) != (file["feed"], file["no"]):
                close()
                file = {}
            if not file:
                if row["feed"] != state["feed"]:
                    state = {"feed": row["feed"], "prev": set(), "types": {}, "roots": {}, "first": True}
                file = {"feed": row["feed"], "no": row["file_no"], "fields": {}}
            file["fields"][row["field"]] = (row["kind"], row["old"])
        if len(out["feed"]) > 20_000:
            yield _batch(out)
    close()
    yield _batch(out)


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"file_no": pa.int32()}
    made = pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()})
    for v in out.values():
        v.clear()
    return made


def lineage(recs: DataFrame, types: bool = True) -> DataFrame:
    """Ordered changes (``change`` set) and, per file and field, the JSON type, the lattice types and the field's lineage (``change`` null)."""
    header = cut_lineage(headers(recs, types))
    named = header.join(renames(recs, header), ["feed", "file_no", "field"], "left")
    ordered = named.select("feed", F.col("file_no").cast("int").alias("file_no"), "field", "kind", "old")
    folded = ordered.repartition("feed").sortWithinPartitions("feed", "file_no", "field").mapInArrow(_fold, LINEAGE)
    if not types:
        return folded
    return folded.join(header.select("feed", "file_no", "field", "types"), ["feed", "file_no", "field"], "left")


def changes(raw: DataFrame) -> DataFrame:
    """``(feed, file_no, change, field)``: every change of a file against the file before it."""
    return lineage(records(raw), types=False).where(F.col("change").isNotNull()).select("feed", "file_no", "change", "field")


def union_schema(lines: DataFrame) -> DataFrame:
    """``(feed, lineage, name, kind)``: each field under its latest name, unique within its feed, with the join of its types."""
    last = F.max(F.struct("file_no", "field")).alias("last")
    fields = lines.where(F.col("change").isNull()).groupBy("feed", "lineage").agg(last, promote(F.array_distinct(F.flatten(F.collect_set("types")))).alias("kind"))
    newest = W.partitionBy("feed", "last.field").orderBy(F.desc("last.file_no"), "lineage")
    ranked = fields.withColumn("_n", F.row_number().over(newest))
    name = F.when(F.col("_n") == 1, F.col("last.field")).otherwise(F.concat("last.field", F.lit("@"), "lineage"))
    return ranked.select("feed", "lineage", name.alias("name"), "kind")


def typed_text(value: Column, to: Column) -> Column:
    """A variant as the text of its union type: a string as it is, everything else as JSON, keys of an object in order, numbers without trailing zeros."""
    plain = F.try_variant_get(value, "$", "string")
    return F.when((to == "string") & F.schema_of_variant(value).isin("STRING"), plain).when(to.isin("date", "timestamp"), plain).otherwise(F.to_json(value))


def cells(recs: DataFrame, lines: DataFrame) -> DataFrame:
    """``(rec_id, feed, file_no, line_no, rec_key, name, kind, value)``: every value of every record under its latest name, as text of its union type.

    A JSON null is a null value; a field that a record lacks has no row.
    """
    schema = union_schema(lines)
    naming = lines.where(F.col("change").isNull()).select("feed", "file_no", "field", "lineage").join(schema, ["feed", "lineage"]).drop("lineage")
    flat = recs.select("rec_id", "feed", "file_no", "line_no", "rec_key", F.explode(fields_of(F.col("body"))).alias("e"))
    value = F.when(F.schema_of_variant("e.value") != "VOID", typed_text(F.col("e.value"), F.col("kind")))
    return flat.withColumn("field", F.col("e.key")).join(naming, ["feed", "file_no", "field"]).select("rec_id", "feed", "file_no", "line_no", "rec_key", "name", "kind", value.alias("value"))


def unify(raw: DataFrame) -> DataFrame:
    """One consistent table of all records of all feeds: ``(rec_id, feed, file_no, line_no, rec_key, fields)``.

    ``fields`` maps the latest name of each field to its text in the union type; ``feed_table`` gives typed columns.
    """
    recs = records(raw)
    each = cells(recs, cut_lineage(lineage(recs)))
    maps = each.groupBy("rec_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("fields"))
    return recs.select("rec_id", "feed", "file_no", "line_no", "rec_key").join(maps, "rec_id", "left")


def column_type(kind: str) -> str:
    return f"array<{SQL_TYPES.get(kind[5:-1], 'string')}>" if kind.startswith("list<") else SQL_TYPES[kind]


def feed_table(raw: DataFrame, feed: str) -> DataFrame:
    """All records of one feed with a typed column per field: ``(rec_id, file_no, line_no, rec_key, <fields>)``.

    The feed's schema (a row per field) is read to the driver to make the columns; names that clash with the first four
    columns in any case get a trailing underscore.
    """
    recs = records(raw.where(F.col("feed") == feed))
    lines = cut_lineage(lineage(recs))
    fields = union_schema(lines).orderBy("name").collect()
    sources: dict[str, list[tuple[int, str]]] = {}
    for r in lines.where("change IS NULL").select("lineage", "file_no", "field").collect():
        sources.setdefault(r["lineage"], []).append((r["file_no"], r["field"]))
    values = recs.select("rec_id", "file_no", "line_no", "rec_key", F.try_variant_get("body", "$", "map<string,variant>").alias("_m"))
    out, taken = [], {"rec_id", "file_no", "line_no", "rec_key"}
    for f in fields:
        by_name: dict[str, list[int]] = {}
        for no, name in sources[f["lineage"]]:
            by_name.setdefault(name, []).append(no)
        value = F.coalesce(*[F.when(F.col("file_no").isin(*nos), F.try_element_at("_m", F.lit(name))) for name, nos in by_name.items()])
        text = typed_text(value, F.lit(f["kind"]))
        made = F.when(F.schema_of_variant(value) != "VOID", text) if f["kind"] == "string" else F.try_variant_get(value, "$", column_type(f["kind"]))
        name = f["name"]
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(made.alias(name))
    return values.select("rec_id", "file_no", "line_no", "rec_key", *out)
