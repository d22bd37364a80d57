"""Deterministic person rows: clean, failing and changing, from ``range`` and hashes of (seed, row)."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators import merge

#: Values of a learned distribution, which becomes a literal.
MOST_VALUES = 10_000
GENDERS = (8507, 8532, 8551)
KINDS = ("null_id", "bad_gender", "future_year", "old_year", "bad_month", "bad_day")
COLUMNS = "person_id int, gender_concept_id int, year_of_birth int, month_of_birth int, day_of_birth int, birth_datetime date, race_concept_id int, ethnicity_concept_id int, location_id string, provider_id string, care_site_id string, person_source_value string, gender_source_value string, gender_source_concept_id int, race_source_value string, race_source_concept_id int, ethnicity_source_value string, ethnicity_source_concept_id int, created_timestamp timestamp_ntz, updated_timestamp timestamp_ntz, is_deleted boolean, business_effective_date date"


def draw(seed: int, name: str, row: str = "id") -> Column:
    """A number in [0, 1), fixed by seed, name and row: one draw that many branches can use."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(name), F.col(row)), 11) / F.lit(float(1 << 53))


def integer(seed: int, name: str, low: int, high: int) -> Column:
    """A whole number from low to high, both included."""
    return (F.lit(low) + F.floor(draw(seed, name) * (high - low + 1))).cast("int")


def people(spark: SparkSession, n: int, as_of: dt.datetime, seed: int = 1, first_id: int = 1) -> DataFrame:
    from stratiform.functions.expr import safe_date

    base = spark.range(n).withColumns({"u": draw(seed, "gender"), "y": integer(seed, "year", 1930, as_of.year - 1), "m": integer(seed, "month", 1, 12), "d": integer(seed, "day", 1, 28)})
    gender = F.when(F.col("u") < 0.49, 8507).when(F.col("u") < 0.98, 8532).otherwise(8551)
    at = F.lit(as_of).cast("timestamp_ntz")
    person = (F.col("id") + first_id).cast("int")
    none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    return base.select(
        person.alias("person_id"), gender.alias("gender_concept_id"), F.col("y").alias("year_of_birth"), F.col("m").alias("month_of_birth"), F.col("d").alias("day_of_birth"), safe_date("y", "m", "d").alias("birth_datetime"),
        F.lit(8527).alias("race_concept_id"), F.lit(38003564).alias("ethnicity_concept_id"), (person * 10).cast("string").alias("location_id"), none_s.alias("provider_id"), none_s.alias("care_site_id"),
        F.concat(F.lit("PSV_"), F.lpad(person.cast("string"), 8, "0")).alias("person_source_value"), F.when(gender == 8507, "M").when(gender == 8532, "F").otherwise("U").alias("gender_source_value"),
        none_i.alias("gender_source_concept_id"), none_s.alias("race_source_value"), none_i.alias("race_source_concept_id"), none_s.alias("ethnicity_source_value"), none_i.alias("ethnicity_source_concept_id"),
        at.alias("created_timestamp"), at.alias("updated_timestamp"), F.lit(False).alias("is_deleted"), F.lit(as_of.date()).alias("business_effective_date"),
    )


def with_errors(clean: DataFrame, rate: float, seed: int = 1, as_of_year: int = 2026) -> DataFrame:
    """The rows, a share of them broken in one of six ways."""
    row = clean.withColumn("_u", draw(seed, "broken", "person_id")).withColumn("_k", F.when(F.col("_u") < rate, F.floor(F.col("_u") / rate * len(KINDS)).cast("int")))
    return _broken(row, as_of_year).drop("_u", "_k")


def _broken(row: DataFrame, as_of_year: int) -> DataFrame:
    """Break each row in the way that ``_k`` numbers."""
    kind = {k: F.col("_k") == i for i, k in enumerate(KINDS)}
    pick = lambda yes, value, c: F.when(yes, F.lit(value)).otherwise(F.col(c)).cast("int")
    changed = {
        "person_id": pick(kind["null_id"], None, "person_id"), "gender_concept_id": pick(kind["bad_gender"], 9999, "gender_concept_id"),
        "year_of_birth": F.when(kind["future_year"], as_of_year + 2).when(kind["old_year"], 1899).otherwise(F.col("year_of_birth")).cast("int"),
        "month_of_birth": pick(kind["bad_month"], 13, "month_of_birth"), "day_of_birth": pick(kind["bad_day"], 32, "day_of_birth"),
    }
    return row.withColumns(changed)


def with_error_quotas(clean: DataFrame, quotas: Mapping[str, int], n: int, first_id: int = 1, as_of_year: int = 2026) -> DataFrame:
    """Exactly ``quotas[kind]`` rows broken in each way, spread over the ``n`` consecutive ids from ``first_id``; no shuffle.

    A step that shares no factor with ``n`` carries the ids to places 0 to n - 1; each kind owns a range of places.
    """
    if unknown := set(quotas) - set(KINDS):
        raise ValueError(f"no such kinds: {sorted(unknown)}")
    if sum(quotas.values()) > n:
        raise ValueError(f"{sum(quotas.values())} broken rows of {n}")
    step = next(k for k in range(max(1, int(n * 0.618)), 2 * n + 2) if math.gcd(k, n) == 1)
    place = F.pmod((F.col("person_id") - first_id).cast("long") * step, F.lit(n))
    kind, upto = F.lit(None).cast("int"), sum(quotas.values())
    for i in reversed(range(len(KINDS))):
        kind = F.when(place < upto, i).otherwise(kind)
        upto -= quotas.get(KINDS[i], 0)
    kind = F.when(place < sum(quotas.values()), kind)
    return _broken(clean.withColumn("_k", kind), as_of_year).drop("_k")


def scd_updates(current: DataFrame, n: int, as_of: dt.datetime, year_shift: int = 0) -> DataFrame:
    """The n least persons with the next gender code and a shifted year of birth, as source rows of ``as_of``."""
    gender = F.when(F.col("gender_concept_id") == 8507, 8532).when(F.col("gender_concept_id") == 8532, 8551).otherwise(8507)
    at = F.lit(as_of).cast("timestamp_ntz")
    year = (F.col("year_of_birth") + year_shift).cast("int")
    return current.orderBy("person_id").limit(n).withColumns({"gender_concept_id": gender, "year_of_birth": year, "updated_timestamp": at, "business_effective_date": F.lit(as_of.date())})


def merge_updates(source: DataFrame, updates: DataFrame) -> DataFrame:
    """The source with the updated rows in place of theirs."""
    return merge.upsert(source, updates, ["person_id"])


def weights(df: DataFrame, column: str, most: int = MOST_VALUES) -> DataFrame:
    """Values in order with their share and cumulative share: a learned distribution, of at most ``most`` values."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).limit(most + 1)
    values = sorted((r[0], r["n"]) for r in counted.collect())
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    total, upto, out = sum(n for _, n in values), 0, []
    for v, n in values:
        upto += n
        out.append((v, n, n / total, upto / total))
    kind = df.schema[column].dataType.simpleString()
    return df.sparkSession.createDataFrame(out, f"`{column}` {kind}, n long, weight double, upto double")


def drawn(u: Column, learned: DataFrame, column: str) -> Column:
    """The value of a learned distribution for a number in [0, 1): the first whose cumulative share lies above it."""
    rows = learned.orderBy("upto").select(column, "upto").collect()  # of at most MOST_VALUES values
    if not rows:
        return F.lit(None).cast(learned.schema[column].dataType)
    below = F.size(F.filter(F.array(*[F.lit(float(r["upto"])) for r in rows[:-1]]), lambda x: x <= u)) if len(rows) > 1 else F.lit(0)
    return F.element_at(F.array(*[F.lit(r[0]) for r in rows]), below + 1).cast(learned.schema[column].dataType)


def learned_people(spark: SparkSession, like: DataFrame, n: int, as_of: dt.datetime, seed: int = 1, first_id: int = 1, columns: Sequence[str] = ("gender_concept_id", "year_of_birth", "race_concept_id")) -> DataFrame:
    """Clean rows whose named columns follow the distributions in ``like``; each has a draw of its own."""
    from stratiform.functions.expr import safe_date

    learned = {c: drawn(draw(seed, f"learned {c}", "person_id"), weights(like, c), c) for c in columns}
    return people(spark, n, as_of, seed, first_id).withColumns(learned).withColumn("birth_datetime", safe_date("year_of_birth", "month_of_birth", "day_of_birth"))


def seed_rows(spark: SparkSession, seed: int = 11) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three batches to be loaded one by one: 15 clean rows, 3 that fail a rule each, 5 late changes of clean ones."""
    loaded, checked, changed = dt.datetime(2026, 1, 5, 8), dt.datetime(2026, 1, 20, 8), dt.datetime(2026, 2, 25, 8)
    clean = people(spark, 15, loaded, seed, first_id=501)
    quotas = {"null_id": 1, "bad_gender": 1, "future_year": 1}
    bad = with_error_quotas(people(spark, 3, checked, seed, first_id=801), quotas, 3, 801, checked.year)
    late = scd_updates(clean, 5, changed).withColumn("business_effective_date", F.lit(dt.date(2026, 1, 12)))
    return clean, bad, late
