"""Canonical records, renames and report shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.labels import name_parts
from textquarry.functions.text import pascal_case, strip_prefix, title_missing_from_head
from textquarry.operators.reference_lists import INTERNAL_KEYS, language_map

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)
PUBLISHED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("messages", MESSAGES, True),
        T.StructField("metadata", T.StringType(), True),
    ]
)


def to_published(
    df: DataFrame,
    source: str | None = None,
    source_key: str | None = None,
    language: str | None = None,
    language_key: str | None = None,
    id_key: str = "id",
    conversation_key: str | None = None,
    remove_keys: tuple[str, ...] = (),
    reset_id: bool = False,
    remove_prefix: bool = False,
) -> DataFrame:
    """Map any document table to the published schema.

    Identifier, language and source come from a column or a constant, everything
    else that is not dropped goes into one JSON string. Language and source are
    mandatory. A reset id is the md5 of the old one, so a re-run gives it again.
    """
    def required(key: str | None, constant: str | None, what: str) -> Column:
        value = F.col(key).cast("string") if key else F.lit(constant).cast("string")
        return F.coalesce(value, F.raise_error(F.lit(f"{what} must be given")).cast("string"))

    text = strip_prefix(F.col("text"), F.col("prefix")) if remove_prefix and "prefix" in df.columns else F.col("text")
    used = {k for k in (source_key, language_key, id_key, conversation_key) if k}
    rest = [c for c in df.columns if c not in used | {"text"} | set(remove_keys) | set(INTERNAL_KEYS)]
    doc_id = F.col(id_key).cast("string")
    return df.select(
        required(source_key, source, "source").alias("source"),
        (F.md5(doc_id) if reset_id else doc_id).alias("id"),
        required(language_key, language, "language").alias("language"),
        text.alias("text"),
        (F.col(conversation_key) if conversation_key else F.lit(None)).cast(MESSAGES).alias("messages"),
        (F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("{}")).alias("metadata"),
    )


def map_language(column: Column, source: str = "iso1", target: str = "iso3", fallback: bool = True) -> Column:
    """Translate language codes by a fixed table; unknown codes stay or become NULL."""
    pairs = language_map(source, target)
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    mapped = F.try_element_at(table, column)
    return F.coalesce(mapped, column) if fallback else mapped


def add_prefix(df: DataFrame, fields: list[tuple[str, Column]], text: str = "text") -> DataFrame:
    """Put ``Label: value`` lines before the text, in order, skipping NULL and empty values.

    The block and its closing blank line are remembered in ``prefix``.
    """
    lines = [
        F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"{label}: "), value)) for label, value in fields
    ]
    block = F.concat_ws("\n", *lines)
    prefix = F.when(block == "", F.lit("")).otherwise(F.concat(block, F.lit("\n\n")))
    return df.withColumn("prefix", prefix).withColumn(text, F.concat(F.col("prefix"), F.col(text)))


def title_field(text: Column, title: Column) -> Column:
    """A title worth showing: present and not already in the first lines."""
    return F.when(title_missing_from_head(text, title), title)


def drop_constant_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep columns with at least two distinct non-NULL values, and the protected ones.

    Smallest and largest value tell whether a column varies, so one aggregation
    over the table is enough and nothing is deduplicated.
    """
    probes = []
    for i, c in enumerate(df.columns):
        as_text = F.col(f"`{c}`").cast("string")
        probes.append((F.min(as_text) != F.max(as_text)).alias(f"v{i}"))
    varies = df.agg(*probes).first()
    chosen = [c for i, c in enumerate(df.columns) if c in keep or varies[i]]
    return df.select(*[F.col(f"`{c}`") for c in chosen])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to one column per leaf, named by the path."""
    leaves: list[tuple[str, str]] = []

    def walk(schema: T.StructType, path: str, name: str) -> None:
        for field in schema.fields:
            p = f"{path}.`{field.name}`" if path else f"`{field.name}`"
            n = f"{name}{sep}{field.name}" if name else field.name
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType, p, n)
            else:
                leaves.append((p, n))

    walk(df.schema, "", "")
    return df.select(*[F.col(p).alias(n) for p, n in leaves])


def short_names(df: DataFrame, sep: str = ".") -> DataFrame:
    """Keep the last part of dotted names; the first column of a name wins."""
    chosen: dict[str, str] = {}
    for c in df.columns:
        chosen.setdefault(c.rsplit(sep, 1)[-1], c)
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in chosen.items()])


def with_name_parts(df: DataFrame, name: str = "name") -> DataFrame:
    return df.select("*", name_parts(F.col(name)).alias("_p")).select(*df.columns, "_p.*")


def build_catalog(df: DataFrame, path: str = "path", depth: int = 1) -> DataFrame:
    """Logical data sets from file paths below ``data/``.

    Files are grouped by their first ``depth`` folders, each group gets a
    readable name and a file glob; names with a hyphen sort last.
    """
    parts = F.split(F.col(path), "/")
    folders = F.slice(parts, F.lit(2), F.greatest(F.least(F.size(parts) - 2, F.lit(depth)), F.lit(0)))
    grouped = (
        df.where(F.startswith(F.col(path), F.lit("data/")) & (F.size(folders) > 0))
        .groupBy(F.array_join(folders, "/").alias("folder"))
        .agg(F.count("*").alias("files"))
    )
    first = pascal_case(F.substring_index("folder", "/", 1))
    second = F.when(F.contains("folder", F.lit("/")), F.concat(F.lit("-"), F.element_at(F.split("folder", "/"), 2)))
    return grouped.select(
        F.concat(first, F.coalesce(second, F.lit(""))).alias("name"),
        F.concat(F.lit("data/"), F.col("folder"), F.lit("/**/*.parquet")).alias("glob"),
        "files",
    )


def plain_first(name: str) -> list[Column]:
    """Sort key: names without a hyphen first, then alphabetical."""
    return [F.contains(F.col(name), F.lit("-")).asc(), F.col(name).asc()]
