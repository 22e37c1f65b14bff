"""Raw status lines whose fields drift, read through VARIANT (SRC1).

``sources.raw`` reads lines by a declared schema: a field of another type than
declared makes the line a bad one.  Here a line is parsed once into a VARIANT
and each field is then taken and cast by itself, so a feed that adds fields,
leaves some out or writes a number as text still gives the record: what cannot
be cast is null, in that field only.

Defined cases: blank lines are skipped; a line that is no JSON fails the read
(``FAILFAST``) or is a status without values (``PERMISSIVE``), and
``variant_bad_lines`` lists such lines; JSON that is no object is a status
without values; of a field that an object repeats the parser decides (it is a
bad line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulse.sources.raw import from_raw, raw_schema

LINE = "value"  # the column that Spark's text source reads a line into


def variants(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """The lines with ``v``, their VARIANT; other columns stay."""
    parse = {"FAILFAST": F.parse_json, "PERMISSIVE": F.try_parse_json}[mode]
    rest = [c for c in lines.columns if c != LINE]
    return lines.where(F.trim(LINE) != "").select(parse(LINE).alias("v"), *rest)


def from_variant(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Lines (column ``value``) as status records; columns that begin with ``_`` stay."""
    rows = variants(lines, mode)
    fields = [F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in raw_schema().fields]
    return from_raw(rows.select(*fields, *[c for c in rows.columns if c.startswith("_")]))


def variant_bad_lines(lines: DataFrame) -> DataFrame:
    """The lines that are no JSON."""
    return lines.where(F.trim(LINE) != "").where(F.try_parse_json(LINE).isNull())


def field_kinds(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """(field, kind, n): the top-level fields of a feed, the JSON types they come in, and how often.

    A row a field and type, whatever the number of lines: it shows what drifts.
    """
    rows = variants(lines, mode).where("v is not null and schema_of_variant(v) like 'OBJECT<%'")
    each = rows.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)  # nested types are not told apart
    return each.groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
