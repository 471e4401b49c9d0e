"""Change-event envelopes: JSON text in, typed columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import ntz_from_micros, try_bigint
from tidemark.schemas import CdcTableSpec

META = ("kafka_ts", "kafka_partition", "kafka_offset")


def _typed(value: Column, kind: str | None) -> Column:
    if kind is None:
        return value
    if kind == "micros":
        return ntz_from_micros(try_bigint(value))
    return value.try_cast(kind)


def parse_envelope(
    df: DataFrame, spec: CdcTableSpec, keep: tuple[str, ...] = META, mode: str = "from_json",
) -> DataFrame:
    """Read op, ts_ms and the table's columns out of ``v``; both envelope shapes parse.

    A field is looked up inside ``payload`` first, then at the top level. NULL,
    malformed or incomplete JSON gives NULL fields, never an error.

    ``from_json`` parses each text once. It sits inside a generator because the
    optimizer otherwise copies the parse into every reference of a pushed-down
    filter, which costs several parses per row. ``get_json_object`` parses once per
    looked-up path and is kept for comparison: it prints numbers in normal form
    (``1.50`` as ``1.5``) where ``from_json`` keeps the text as sent.
    """
    if mode == "from_json":
        image = "struct<" + ",".join(f"`{c}`:string" for c in spec.columns) + ">"
        fields = f"op:string,ts_ms:string,before:{image},after:{image}"
        schema = f"struct<payload:struct<{fields}>,{fields}>"
        df = df.selectExpr(*keep, f"explode(array(from_json(v, '{schema}'))) AS _e")
        field = "_e.{}".format
    elif mode == "get_json_object":
        field = "get_json_object(v, '$.{}')".format
    else:
        raise ValueError(f"unknown parse mode {mode!r}")

    def lookup(*paths: str) -> str:
        return f"coalesce({', '.join(field(p) for path in paths for p in (f'payload.{path}', path))})"

    columns = [F.expr(lookup("op")).alias("op"), try_bigint(F.expr(lookup("ts_ms"))).alias("ts_ms")]
    for name in spec.columns:
        images = [f"after.{name}"] + ([f"before.{name}"] if name not in spec.attrs else [])
        columns.append(_typed(F.expr(lookup(*images)), spec.casts.get(name)).alias(name))
    return df.select(*keep, *columns)
