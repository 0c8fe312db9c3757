"""Validation, normalisation and conformance of incoming records.

Rules are column expressions collected into an ``array<string>`` of
violation codes per row (``array_compact`` of ``when`` clauses), so one pass
splits a frame into accepted and rejected rows; a bad record never fails the
whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.functions import scalars as S


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    default: object = None


# Fixed record layout of a scoring request, in order (id first).
RECORD_FIELDS = [
    Field("subject_id", "bigint"),
    Field("tier", "int"),
    Field("full_name", "string", S.DEFAULT_NAME),
    Field("sex", "string"),
    Field("age", "double"),
    Field("sibsp", "int", 0),
    Field("parch", "int", 0),
    Field("ticket", "string", S.DEFAULT_TICKET),
    Field("fare", "double"),
    Field("cabin", "string"),
    Field("port", "string"),
]

# Accepted ranges and sets of the record rules.
TIER_RANGE = (1, 3)
AGE_RANGE = (0.0, 120.0)
SEX_VALUES = ("male", "female")
PORT_VALUES = ("S", "C", "Q")


def drop_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop listed columns; absent ones are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_string_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c for c, t in df.dtypes if t != "string" or c in keep])


def conform(df: DataFrame, fields: Sequence[Field] = RECORD_FIELDS,
            keep_extra: bool = False, null_as_absent: bool = False) -> DataFrame:
    """Fixed column list and order; absent columns get their default,
    present ones are cast (``try_cast``: bad text becomes NULL, not an error),
    NULL counts get their default.  With ``null_as_absent`` (JSON, where an
    absent field parses to NULL) every NULL gets its field's default."""
    cols = []
    for f in fields:
        if f.name in df.columns:
            c = F.col(f.name).try_cast(f.dtype)
            if f.dtype == "double":
                c = S.nan_to_null(c)
            numeric = f.dtype in ("int", "bigint", "double")
            if f.default is not None and (numeric or null_as_absent):
                c = F.coalesce(c, F.lit(f.default).cast(f.dtype))
        else:
            c = F.lit(f.default).cast(f.dtype)
        cols.append(c.alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in fields}] if keep_extra else []
    return df.select(*cols, *extra)


def normalised_fields(get) -> dict[str, Column]:
    """Normalised rule inputs from a field getter (``F.col`` for a frame,
    ``lambda n: x[n]`` inside an array lambda): sex lower-cased, port
    upper-cased, counts defaulted to 0.  Nothing is trimmed: a blank or
    padded port is an invalid one."""
    return {
        "tier": get("tier").try_cast("int"),
        "sex": F.lower(get("sex")),
        "age": S.nan_to_null(get("age").try_cast("double")),
        "sibsp": F.coalesce(get("sibsp").try_cast("int"), F.lit(0)),
        "parch": F.coalesce(get("parch").try_cast("int"), F.lit(0)),
        "fare": S.nan_to_null(get("fare").try_cast("double")),
        "port": F.upper(get("port")),
    }


RULED_FIELDS = ("tier", "sex", "age", "sibsp", "parch", "fare", "port")


def _rules(v: dict[str, Column]) -> list[tuple[Column, str]]:
    """(whether a normalised record breaks the rule, code of the rule)"""
    t, s, a, f, p = v["tier"], v["sex"], v["age"], v["fare"], v["port"]
    return [
        (t.isNull() | (t < TIER_RANGE[0]) | (t > TIER_RANGE[1]), "tier_out_of_range"),
        (s.isNull() | ~s.isin(*SEX_VALUES), "sex_invalid"),
        (a.isNotNull() & ((a < AGE_RANGE[0]) | (a > AGE_RANGE[1])), "age_out_of_range"),
        (v["sibsp"] < 0, "sibsp_negative"),
        (v["parch"] < 0, "parch_negative"),
        (f.isNotNull() & (f < 0), "fare_negative"),
        (p.isNotNull() & ~p.isin(*PORT_VALUES), "port_invalid"),
    ]


def rule_codes(v: dict[str, Column]) -> Column:
    """Array of rule codes a normalised record breaks; empty when valid."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in _rules(v)]))


def normalise(df: DataFrame, sex: str = "sex", port: str = "port") -> DataFrame:
    """sex lower-cased; port upper-cased."""
    return df.withColumn(sex, F.lower(F.col(sex))).withColumn(port, F.upper(F.col(port)))


def violations() -> Column:
    return rule_codes(normalised_fields(F.col))


def validate(df: DataFrame, out_col: str = "violations") -> DataFrame:
    """normalise + rule codes (``out_col``) for every row."""
    return normalise(df).withColumn(out_col, violations())


def accepted(validated: DataFrame, col: str = "violations") -> DataFrame:
    return validated.where(F.size(col) == 0).drop(col)


def rejected(validated: DataFrame, col: str = "violations") -> DataFrame:
    return validated.where(F.size(col) > 0)


# ---------------------------------------------------------------- JSON requests

# Fields of a JSON record: type, and whether an explicit null is allowed.  An absent field takes its
# default (tier and sex have none and break their own rules).
JSON_FIELDS = {
    "tier": ("int", False), "sex": ("string", False), "age": ("double", True), "sibsp": ("int", False),
    "parch": ("int", False), "fare": ("double", True), "port": ("string", True),
    "full_name": ("string", False), "ticket": ("string", False), "cabin": ("string", True),
}


RECORD_VARIANTS = f"array<struct<{','.join(f'{n}:variant' for n in JSON_FIELDS)}>>"
RECORD_TEXTS = f"array<struct<{','.join(f'{n}:string' for n in JSON_FIELDS)}>>"
RECORD_VALUES = f"array<struct<{','.join(f'{n}:' + ('string' if k == 'string' else 'double') for n, (k, _) in JSON_FIELDS.items())}>>"


def _fits(given: Column, value: Column, name: str) -> Column:
    """Whether a field that is there has its type.  Numbers may come as text, text may not come as
    numbers, a count must be whole."""
    kind, _ = JSON_FIELDS[name]
    if kind == "string":
        return F.coalesce(F.schema_of_variant(given) == "STRING", F.lit(False))
    number = value.isNotNull() & ~F.isnan(value)
    return number & (value == F.floor(value)) & value.try_cast("int").isNotNull() if kind == "int" else number


def _wrong(given: Column, value: Column, name: str) -> Column:
    """Whether the type is wrong; null is a value only where allowed."""
    wrong = given.isNotNull() & ~_fits(given, value, name)
    return wrong & ~F.is_variant_null(given) if JSON_FIELDS[name][1] else wrong


def _records(body: Column) -> Column:
    """The typed records of a request, with their wrong types and whether they break a rule.

    A function inside an array is worked out as it is written, shared parts as often as they appear; so fields are read by two
    casts of the whole array, and each further step (type, normalise, judge) is an array of its own.
    """
    given = F.try_variant_get(body, "$.passengers", RECORD_VARIANTS)
    values = F.try_variant_get(body, "$.passengers", RECORD_TEXTS).try_cast(RECORD_VALUES)

    def typed(g: Column, v: Column) -> Column:
        return F.struct(*[F.struct(F.when(_fits(g[n], v[n], n), v[n].try_cast(k)).alias("value"), _wrong(g[n], v[n], n).alias("wrong")).alias(n)
                          for n, (k, _) in JSON_FIELDS.items()])

    def record(x: Column) -> Column:
        wrong = F.array_compact(F.array(*[F.when(x[n]["wrong"], F.lit(f"{n}_type")) for n in JSON_FIELDS]))
        ruled = normalised_fields(lambda n: x[n]["value"])
        return F.struct(*[x[n]["value"].alias(n) for n in JSON_FIELDS], wrong.alias("_types"),
                        F.struct(*[c.alias(n) for n, c in ruled.items()]).alias("_ruled"))

    def judged(x: Column) -> Column:
        broken = reduce(lambda a, b: a | b, [c for c, _ in _rules({n: x["_ruled"][n] for n in RULED_FIELDS})], F.size(x["_types"]) > 0)
        return F.struct(*[x[n].alias(n) for n in [*JSON_FIELDS, "_types"]], broken.alias("_bad"))

    return F.transform(F.transform(F.zip_with(given, values, typed), record), judged)


def explode_requests(requests: DataFrame, request_id: str = "request_id",
                     body: str = "body") -> DataFrame:
    """One JSON request per row -> one record per row.

    ``passenger_index`` is the position in the request, ``subject_id`` that + 1; a request without
    records yields one row with NULL for both, and ``_malformed`` tells whether it was no JSON at all.
    ``_types`` lists the record's wrongly typed fields.  ``_request_bad`` tells whether any record of
    the request breaks a rule -- computed on the parsed array with a higher-order function, so it needs no
    grouping and works on streams.
    """
    parsed = requests.select(request_id, F.try_parse_json(F.col(body)).alias("_v"))
    parsed = parsed.select(request_id, F.col("_v").isNull().alias("_malformed"), _records(F.col("_v")).alias("_recs"))
    recs = F.col("_recs")
    bad = (F.coalesce(F.size(recs), F.lit(0)) <= 0) | F.exists(recs, lambda x: x["_bad"])
    # once per request: after the explode, every record would walk through its whole request again
    judged = parsed.select(request_id, "_malformed", bad.alias("_request_bad"), "_recs")
    exploded = judged.select(request_id, "_malformed", "_request_bad", F.posexplode_outer("_recs").alias("_pos", "_p"))
    return exploded.select(request_id, "_malformed", "_request_bad",
                           F.col("_pos").cast("bigint").alias("passenger_index"),
                           (F.col("_pos") + 1).cast("bigint").alias("subject_id"),
                           *[F.col(f"_p.{n}").alias(n) for n in [*JSON_FIELDS, "_types"]])


def validate_requests(records: DataFrame, whole_request: bool = True) -> DataFrame:
    """conform + normalise + rules and types, with ``empty_request`` and ``malformed_json`` rules.

    With ``whole_request`` (the default, like a request-level schema check)
    one invalid record rejects every record of its request: the valid
    siblings get ``request_rejected``.
    """
    v = validate(conform(records, keep_extra=True, null_as_absent=True))
    own = F.concat("violations", F.coalesce("_types", F.array().cast("array<string>")))
    none = F.when(F.col("_malformed"), F.array(F.lit("malformed_json"))).otherwise(F.array(F.lit("empty_request")))
    v = v.withColumn("violations", F.when(F.col("subject_id").isNull(), none).otherwise(own))
    if whole_request:
        v = v.withColumn("violations", F.when(F.col("_request_bad") & (F.size("violations") == 0),
                                              F.array(F.lit("request_rejected")))
                         .otherwise(F.col("violations")))
    return v.drop("_request_bad", "_malformed", "_types")
