"""Column expressions: hashes, keys, ages, bands, recoding and safe parsing. No Python UDFs, no wall clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)
#: The codes of unknown gender, race and ethnicity, and the gender codes that count as compliant.
UNKNOWN_GENDER, UNKNOWN_RACE, UNKNOWN_ETHNICITY = 8551, 0, 7
COMPLIANT_GENDERS = (8507, 8532)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(columns: Sequence[str | Column], separator: str = "||", null: str = "") -> Column:
    """SHA-256 of the columns as text; nulls count as ``null``, and every value carries its length, so no two rows collide by where a separator falls."""
    texts = [F.coalesce(col(c).cast("string"), F.lit(null)) for c in columns]
    return F.sha2(F.concat_ws(separator, *[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), 256)


def change_hash(columns: Sequence[str | Column]) -> Column:
    """``row_hash`` that also tells null from the empty text, for judging whether a row changed."""
    nulls = F.concat(F.lit(""), *[F.when(col(c).isNull(), "0").otherwise("1") for c in columns])
    return row_hash([*columns, nulls])


def plain_hash(columns: Sequence[str | Column], separator: str = "||", null: str = "") -> Column:
    """SHA-256 of the columns joined by the separator, nulls as ``null``."""
    return F.sha2(F.concat_ws(separator, *[F.coalesce(col(c).cast("string"), F.lit(null)) for c in columns]), 256)


def pseudonymize(value: str | Column, salt: str, separator: str = "") -> Column:
    """SHA-256 of value and salt; null and empty values stay null."""
    v = col(value).cast("string")
    return F.when(v.isNotNull() & (v != ""), F.sha2(F.concat(v, F.lit(separator + salt)), 256))


def business_key(value: str | Column, salt: str) -> Column:
    """A key from an id (never from a name): equal ids give equal keys, null gives null."""
    return pseudonymize(value, salt, "|")


def year_difference(year: str | Column, as_of: dt.date) -> Column:
    return F.lit(as_of.year) - col(year)


def completed_years(born: str | Column, as_of: dt.date) -> Column:
    return F.floor(F.months_between(F.lit(as_of), col(born)) / 12).cast("int")


def band(value: str | Column, bounds: Sequence[tuple[int | None, str]], unknown: str = "Unknown") -> Column:
    """The label of the first bound that the value lies below (None: no bound); null gives ``unknown``."""
    v = col(value)
    out = F.when(v.isNull(), unknown)
    for bound, label in bounds:
        out = out.otherwise(label) if bound is None else out.when(v < bound, label)
    return out


#: Three age bands, and the nineteen of five years each.
BANDS_3 = [(18, "0-17"), (65, "18-64"), (None, "65+")]
BANDS_19 = [(5 * k + 5, f"{5 * k}-{5 * k + 4}") for k in range(18)] + [(None, "90+")]


def recode(value: str | Column, known: Sequence[int], unknown: int) -> Column:
    """The value if it is a known code, else ``unknown`` (for null too)."""
    return F.when(col(value).isin(list(known)), col(value)).otherwise(F.lit(unknown))


def remap(value: str | Column, mapping: Mapping[object, object], default: object = None) -> Column:
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(col(value) == F.lit(k), F.lit(v)).otherwise(out)
    return out


def safe_date(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """The date of three numbers, null if there is no such date (also under ANSI mode)."""
    return F.try_to_date(F.concat_ws("-", *[F.coalesce(col(c).cast("string"), F.lit("?")) for c in (year, month, day)]), "y-M-d")


def safe_timestamp(value: str | Column, form: str) -> Column:
    """The timestamp that the text gives in the format, null if it gives none (also under ANSI mode)."""
    return F.try_to_timestamp(col(value), F.lit(form))


def cleaned(gender: str, race: str, ethnicity: str, year: str, month: str, day: str, as_of: dt.date, genders: Sequence[int], races: Sequence[int], ethnicities: Sequence[int], version: str) -> dict[str, Column]:
    """The seven columns of a cleaned person, for ``withColumns``: codes with unknowns replaced, birth date, age in whole years, its band, and the version of the rules."""
    born = safe_date(year, month, day)
    age = completed_years(born, as_of)
    return {
        "gender_code": recode(gender, genders, UNKNOWN_GENDER),
        "race_code": recode(race, races, UNKNOWN_RACE),
        "ethnicity_code": recode(ethnicity, ethnicities, UNKNOWN_ETHNICITY),
        "birth_date": born,
        "age_years": age,
        "age_band": band(age, BANDS_19),
        "rules_version": F.lit(version),
    }


def compliance_flag(key: str | Column, gender: str | Column, codes: Sequence[int] = COMPLIANT_GENDERS) -> Column:
    return col(key).isNotNull() & F.coalesce(col(gender).isin(list(codes)), F.lit(False))


def bronze_lineage(run_id: str, source: str, pipeline: str, environment: str, as_of: dt.datetime) -> dict[str, Column]:
    """The six columns of a Bronze row, for ``withColumns``."""
    at = F.lit(as_of)
    return {"pipeline_run_id": F.lit(run_id), "ingestion_timestamp": at, "lineage_source": F.lit(source), "lineage_pipeline": F.lit(pipeline), "lineage_environment": F.lit(environment), "lineage_bronze_ts": at}
