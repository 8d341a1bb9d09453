"""From raw export lines to typed, clean ones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import HEADER_RULES, HeaderRule
from ..functions import cleaning as C

FALLBACK_NAMES = {"US$ FOB": "US_FOB", "PAIS DE DESTINO": "PAIS_DESTINO"}
COMPUTED, ONCE = "computed__", "once__"
SAMPLE_COLUMNS = (
    "YEAR", "MES", "PAIS_DESTINO_CLEAN", "PRODUCTO_CLEAN", "FOB_CLEAN",
    "EXPORT_SIZE_CATEGORY", "REGION_ORIGEN_CLEAN",
)


def header_matches(rule: HeaderRule, header: str) -> bool:
    """Whether a trimmed, upper-case header satisfies a rule."""
    if header in rule.names:
        return True
    return (
        bool(rule.words)
        and all(word in header for word in rule.words)
        and (not rule.one_of or any(word in header for word in rule.one_of))
        and not any(word in header for word in rule.without)
    )


def canonical_names(headers: list[str]) -> list[str]:
    """The canonical name of each header.

    An exact name takes its target before any similar one, each target has one
    source, and a header left without a target keeps its name.
    """
    cleaned = [h.lstrip("\ufeff").strip().upper() for h in headers]
    names: list[str | None] = [None] * len(headers)
    free = {rule.target for rule in HEADER_RULES}
    for i, header in enumerate(cleaned):
        if header in free:
            names[i] = header
            free.discard(header)
    for i, header in enumerate(cleaned):
        if names[i] is None:
            rule = next((r for r in HEADER_RULES if header_matches(r, header)), None)
            if rule is not None and rule.target in free:
                names[i] = rule.target
                free.discard(rule.target)
    return distinct_names([new or old for new, old in zip(names, headers)])


def distinct_names(names: list[str]) -> list[str]:
    """Number repeated names, so that every column can be addressed."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        result.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return result


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trimmed, upper-case headers."""
    return df.toDF(*distinct_names([name.strip().upper() for name in df.columns]))


def canonicalise(df: DataFrame) -> DataFrame:
    """Rename by position, one projection whatever the number of columns."""
    return df.toDF(*canonical_names(df.columns))


def with_fallback_names(df: DataFrame) -> DataFrame:
    """The short names that the fallback files use."""
    return canonicalise(df).withColumnsRenamed(FALLBACK_NAMES)


def positive(df: DataFrame, column: str = "FOB_CLEAN") -> DataFrame:
    """P4."""
    return df.filter(C.named(column) > 0)


def evaluated_once(df: DataFrame, value: Column) -> tuple[DataFrame, Column]:
    """The rows with a further column ``ONCE`` of the value, and that column.

    A filter by a computed column is pushed below it, and so computes it twice, with all
    that it is made from. It is not pushed below a generator, here of one row.
    """
    names = df.columns
    df = df.withColumn(COMPUTED, value)
    return df.select(*[C.named(name) for name in names], F.explode(F.array(COMPUTED)).alias(ONCE)), F.col(ONCE)


def coerce_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Text columns to numbers, bad text to null."""
    return df.withColumns({name: C.number_or_null(C.named(name)) for name in columns})


def with_date_numbers(df: DataFrame) -> DataFrame:
    """Year, month and day as integers, where a file gave them as text."""
    text = [n for n in ("YEAR", "MES", "DIA") if dict(df.dtypes).get(n) == "string"]
    return df.withColumns({name: F.col(name).try_cast("int") for name in text}) if text else df


def clean_exports(df: DataFrame, keep_all: bool = False) -> DataFrame:
    """P3-P6, P8-P16 for the columns that are present; lines without a positive
    FOB are dropped unless ``keep_all``."""
    df = with_date_numbers(df)
    present = set(df.columns)

    def has(*names):
        return present.issuperset(names)

    first: dict[str, Column] = {}
    for raw, clean in (
        ("US$ FOB", "FOB_CLEAN"),
        ("PESO BRUTO", "PESO_BRUTO_CLEAN"),
        ("CANTIDAD", "CANTIDAD_CLEAN"),
    ):
        if has(raw):
            first[clean] = C.amount(df, raw)
    if has("YEAR", "MES"):
        day = C.named("DIA") if has("DIA") else None
        first["EXPORT_DATE"] = C.export_date(C.named("YEAR"), C.named("MES"), day)
    if has("PAIS DE DESTINO"):
        first["PAIS_DESTINO_CLEAN"] = C.destination_name(C.named("PAIS DE DESTINO"))
    if has("PRODUCTO"):
        first["PRODUCTO_CLEAN"] = C.label(C.named("PRODUCTO"))
    if has("REGION DE ORIGEN"):
        first["REGION_ORIGEN_CLEAN"] = C.label(C.named("REGION DE ORIGEN"))
        # Folded once here; the 15 group words below then share it.
        first["REGION_GROUP"] = C.region_key(C.named("REGION DE ORIGEN"))
    if "FOB_CLEAN" in first and not keep_all:
        df, first["FOB_CLEAN"] = evaluated_once(df, first["FOB_CLEAN"])
        df = positive(df.withColumns(first).drop(ONCE))
    else:
        df = df.withColumns(first)

    fob = F.col("FOB_CLEAN")
    second: dict[str, Column] = {}
    if {"FOB_CLEAN", "PESO_BRUTO_CLEAN"} <= first.keys():
        second["FOB_PER_KG"] = C.ratio_of_positives(fob, F.col("PESO_BRUTO_CLEAN"))
    if {"FOB_CLEAN", "CANTIDAD_CLEAN"} <= first.keys():
        second["FOB_PER_UNIT"] = C.ratio_of_positives(fob, F.col("CANTIDAD_CLEAN"))
    if "FOB_CLEAN" in first:
        second["EXPORT_SIZE_CATEGORY"] = C.size_band(fob)
    if "REGION_GROUP" in first:
        second["REGION_GROUP"] = C.region_group(F.col("REGION_GROUP"))
    return df.withColumns(second) if second else df


def with_audit(df: DataFrame, processed_at: datetime, method: str = "SPARK") -> DataFrame:
    """When and how the rows were processed; the time is the run's parameter."""
    at = F.lit(processed_at)
    return df.withColumns(
        {"PROCESSED_AT": at, "PROCESSING_DATE": F.to_date(at), "PROCESSING_METHOD": F.lit(method)}
    )


def filter_in(df: DataFrame, column: str, values) -> DataFrame:
    """Keep the listed values; no list or an empty one keeps all."""
    return df.filter(C.named(column).isin(*values)) if values else df


def value_column(df: DataFrame) -> Column:
    """P20: the cleaned FOB where there is one, else the raw FOB as a number."""
    if "FOB_CLEAN" in df.columns:
        return F.col("FOB_CLEAN")
    return C.amount_or_null(df, "US$ FOB")


def keep_columns(df: DataFrame, *names: str) -> DataFrame:
    """Those of the named columns that exist."""
    return df.select(*[C.named(name) for name in names if name in df.columns])


def sample_rows(df: DataFrame, rows: int = 10) -> DataFrame:
    """A few rows to look at, the first by what is shown, so that every run shows the
    same; the first ten columns if none of the usual exist."""
    wanted = [name for name in SAMPLE_COLUMNS if name in df.columns] or df.columns[:10]
    shown = keep_columns(df, *wanted)
    return shown.orderBy(*[C.named(name) for name in shown.columns]).limit(rows)
