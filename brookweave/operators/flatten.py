"""Deeply nested records into flat child tables, one per structural variant.

A bottom-up tree automaton gives every node a state. Leaves are ``null``, ``blank``, ``text`` or ``scalar``; an object
with a text or scalar under its label is ``named``, any other ``object``; a list's state names the set of its elements'
states, to the depth that is unrolled. The state of an element routes it to a typed subtype table; the state of the whole
list is kept as its ``shape``. Every subtype table has the keys of the supertype (parent table, parent id), the link to the
place in the parent (path and position), and columns of its own with their own types:

``text``: ``text_value string`` - ``scalar``: ``scalar_type string, scalar_text string, scalar_number double`` -
``named``: ``name string, fields map<string,string>`` - ``object``: ``fields map<string,string>`` -
``entry``: ``map_key string, map_value string``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.functions.scalars import strip
from brookweave.session import scratch

KEYS = ("parent_table", "parent_id", "elem_path", "elem_pos", "shape")
#: Subtype tables: their own columns and types.
SUBTYPES: Mapping[str, Mapping[str, str]] = {
    "text": {"text_value": "string"},
    "scalar": {"scalar_type": "string", "scalar_text": "string", "scalar_number": "double"},
    "named": {"name": "string", "fields": "map<string,string>"},
    "object": {"fields": "map<string,string>"},
    "entry": {"map_key": "string", "map_value": "string"},
}
#: What an element of a subtype gives as the text of the supertype; an object without a name gives none.
TEXTS = {"text": "text_value", "scalar": "scalar_text", "named": "name", "entry": "map_value"}


def parse_strict(text: Column) -> Column:
    """The text as a variant; null unless the whole text is one JSON value.

    The variant parser stops after the first value. Text that parses both inside brackets and inside braces has
    nothing after that value. Of a key that an object repeats the last value counts; the parser takes that from the
    session alone, so it is set there and stays set.
    """
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    inside = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    return F.when(whole, F.variant_get(inside, "$.v", "variant"))


def _kind(v: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.schema_of_variant(v), r"^[A-Z_]+", 0), F.lit("VOID"))


def node_state(v: Column, label: str = "name", depth: int = 3) -> Column:
    """Automaton state of a node given as a variant. Lists are followed ``depth`` levels down; below, they are ``list``."""
    kind = _kind(v)
    below = F.lit("list")
    if depth:
        states = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e: node_state(e, label, depth - 1))
        below = F.concat(F.lit("list<"), F.array_join(F.array_sort(F.array_distinct(states)), "|"), F.lit(">"))
    named = ~_kind(F.try_variant_get(v, f"$.{label}", "variant")).isin("VOID", "OBJECT", "ARRAY")
    return (
        F.when(v.isNull() | (kind == "VOID"), "null")
        .when(kind == "STRING", F.when(strip(F.try_variant_get(v, "$", "string")) == "", "blank").otherwise("text"))
        .when(kind == "OBJECT", F.when(named, "named").otherwise("object"))
        .when(kind == "ARRAY", below)
        .otherwise("scalar")
    )


def list_state(states: Column) -> Column:
    """Shape of a list, from the states of its elements: of one kind, of several, or empty of anything shown."""
    kept = F.array_sort(F.array_distinct(F.filter(states, lambda x: ~x.isin("null", "blank"))))
    one = F.concat(F.regexp_extract(F.get(kept, F.lit(0)), "^[a-z]+", 0), F.lit("_list"))
    return F.when(states.isNull() | (F.size(kept) == 0), "empty").when(F.size(kept) == 1, one).otherwise("mixed_list")


def flatten_variant_lists(
    df: DataFrame, *, parent: str, row_id: str, document: Column, wrapper: str, paths: Sequence[str], label: str = "name"
) -> DataFrame:
    """Routed elements of the list fields ``paths`` of a JSON document: the supertype's :data:`KEYS`, ``subtype`` and one
    struct per subtype, of which an element fills its own.

    ``document`` is a variant; a document may lie directly or below the key ``wrapper``. A field is a list, a single
    text (shape ``single``, position 0) or a list of objects that give their ``label``. Null and blank elements and lists
    of lists are skipped but counted in the position. A null document and a field that is absent give nothing. No
    shuffle: a row's children are generated in place.
    """
    inner = F.try_variant_get(document, f"$.{wrapper}", "variant")
    root = F.when(F.coalesce(_kind(inner) == "OBJECT", F.lit(False)), inner).otherwise(document)
    fields = df.select(F.col(row_id).alias("parent_id"), root.alias("_root")).where(F.col("_root").isNotNull())
    nodes = F.array(
        *[
            F.struct(F.lit(f"{wrapper}.{p}").alias("elem_path"), F.try_variant_get("_root", f"$.{p}", "variant").alias("_node"))
            for p in paths
        ]
    )
    nodes = fields.select("parent_id", F.explode(nodes).alias("_n")).select("parent_id", "_n.elem_path", "_n._node").where(F.col("_node").isNotNull())
    is_list = _kind(F.col("_node")) == "ARRAY"
    elements = F.when(is_list, F.try_variant_get("_node", "$", "array<variant>")).otherwise(F.array("_node"))
    typed = nodes.select("parent_id", "elem_path", is_list.alias("_list"), elements.alias("_elements")).withColumn(
        "_states", F.transform("_elements", lambda e: node_state(e, label))
    )
    shape = F.when(F.col("_list"), list_state(F.col("_states"))).otherwise("single")
    rows = typed.select("parent_id", "elem_path", shape.alias("shape"), F.posexplode(F.arrays_zip("_elements", "_states")).alias("elem_pos", "_e"))
    e = F.col("_e._elements")
    fields_of = F.try_variant_get(e, "$", "map<string,string>")
    return _routed(
        rows, parent, F.col("_e._states"),
        {
            "text": [strip(F.try_variant_get(e, "$", "string"))],
            "scalar": [_kind(e), F.try_variant_get(e, "$", "string"), F.try_variant_get(e, "$", "double")],
            "named": [strip(F.try_variant_get(e, f"$.{label}", "string")), F.map_filter(fields_of, lambda k, _: k != label)],
            "object": [fields_of],
        },
    )


def flatten_struct_lists(df: DataFrame, *, parent: str, row_id: str, record: str, paths: Sequence[str]) -> DataFrame:
    """Routed elements of list fields of a typed struct; same result and rules as :func:`flatten_variant_lists`."""
    fields = F.array(
        *[F.struct(F.lit(f"{record}.{p}").alias("elem_path"), F.col(f"{record}.{p}").alias("_elements")) for p in paths]
    )
    nodes = df.where(F.col(record).isNotNull()).select(F.col(row_id).alias("parent_id"), F.explode(fields).alias("_n"))
    rows = nodes.select("parent_id", "_n.elem_path", "_n._elements")
    shape = list_state(F.transform("_elements", _text_state))
    rows = rows.select("parent_id", "elem_path", shape.alias("shape"), F.posexplode("_elements").alias("elem_pos", "_e"))
    return _routed(rows, parent, _text_state(F.col("_e")), {"text": [strip(F.col("_e"))]})


def _text_state(e: Column) -> Column:
    return F.when(e.isNull(), "null").when(strip(e) == "", "blank").otherwise("text")


def flatten_map_list(df: DataFrame, *, parent: str, row_id: str, column: str) -> DataFrame:
    """Routed entries of an array of string maps: the path is the column and the map's key, the position the map's place.

    Shapes: ``single_map``, ``map_list`` where all maps have the same keys, ``ragged_maps`` otherwise. Null maps and null
    or blank values give no row; a null or empty array gives none. No shuffle.
    """
    maps = F.col("_maps")
    shapes = F.array_distinct(F.transform(maps, lambda m: F.when(m.isNotNull(), F.array_sort(F.map_keys(m)))))
    shape = F.when(F.size(maps) == 1, "single_map").when(F.size(shapes) == 1, "map_list").otherwise("ragged_maps")
    rows = df.select(F.col(row_id).alias("parent_id"), F.col(column).alias("_maps")).where(F.size("_maps") > 0)
    rows = (
        rows.select("parent_id", shape.alias("shape"), F.posexplode("_maps").alias("elem_pos", "_map"))
        .select("parent_id", "shape", "elem_pos", F.explode("_map").alias("_key", "_value"))
        .withColumn("elem_path", F.concat(F.lit(f"{column}."), "_key"))
    )
    state = F.when(_text_state(F.col("_value")) == "text", "entry")
    return _routed(rows, parent, state, {"entry": [F.col("_key"), strip(F.col("_value"))]})


def _routed(rows: DataFrame, parent: str, state: Column, values: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Elements whose state has a subtype table, with the struct of that subtype filled."""
    structs = []
    for name, own in SUBTYPES.items():
        kind = "struct<" + ",".join(f"{c}:{t}" for c, t in own.items()) + ">"
        if name in values:
            whole = F.struct(*[v.cast(t).alias(c) for v, (c, t) in zip(values[name], own.items())])
            structs.append(F.when(F.col("subtype") == name, whole).cast(kind).alias(f"as_{name}"))
        else:
            structs.append(F.lit(None).cast(kind).alias(f"as_{name}"))
    out = rows.withColumns({"parent_table": F.lit(parent), "subtype": state}).where(F.col("subtype").isin(*values))
    return out.select(*KEYS, "subtype", *structs)


def subtype_table(routed: DataFrame, subtype: str) -> DataFrame:
    """The flat table of one structural variant: the keys of the supertype and its own typed columns."""
    return routed.where(F.col("subtype") == subtype).select(*KEYS, f"as_{subtype}.*")


def write_subtypes(routed: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """Routes the elements to one stored table per subtype below ``path`` and returns the tables; a table's read opens its own
    folder and columns only."""
    path = path or scratch(routed.sparkSession, "subtypes")
    routed.write.mode("overwrite").partitionBy("subtype").parquet(path)
    stored = routed.sparkSession.read.schema(routed.schema).parquet(path)
    return {name: subtype_table(stored, name) for name in SUBTYPES}


def supertype(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The union of the subtype tables as the supertype sees it: ``parent_table, parent_id, elem_path, elem_pos, elem_text,
    subtype``. Blank texts (a blank name) give no row."""
    out = None
    for name, column in TEXTS.items():
        part = tables[name].select(*KEYS[:4], F.col(column).alias("elem_text"), F.lit(name).alias("subtype")).where(F.col("elem_text") != "")
        out = part if out is None else out.unionByName(part)
    return out
