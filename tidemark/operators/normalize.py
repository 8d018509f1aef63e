"""Raw cube rows to typed ones: one projection compiled from a SourceSpec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.specs import AGGREGATE_PREFIXES, SourceSpec

SCALAR_POWERS = (0, 3, 6, 9)


def blank(column: str) -> str:
    return f"nullif(trim(`{column}`), '')"


def normalize(raw: DataFrame, spec: SourceSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Common typed columns, ``geography_key``, ``normalized_value`` and the spec's dimensions, measure and extras.

    Blanks are null; months and numbers that don't parse are null instead of failing the job; flags are two-valued.
    A value is scaled exactly by 10 to the power of SCALAR_ID 0, 3, 6 or 9, any other or no id gives null. Raw columns
    other than the spec's are dropped unless kept by name; an empty table gives none.
    """
    codes = {c: f"upper({blank(c)})" for c in ("STATUS", "SYMBOL", "TERMINATED")}
    either = "coalesce(status_code = '{0}' or symbol_code = '{0}', false)"
    scale = " ".join(f"when {p} then 1{'0' * p}" for p in SCALAR_POWERS)
    first = {
        "source_id": blank("_source_id"), "reference_month": f"to_date(try_to_timestamp({blank('REF_DATE')}, 'yyyy-MM'))", "geography": blank("GEO"), "geography_dguid": blank("DGUID"),
        "unit": blank("UOM"), "unit_id": "try_cast(UOM_ID as int)", "scalar_factor": blank("SCALAR_FACTOR"), "scalar_id": "try_cast(SCALAR_ID as int)",
        "status_code": codes["STATUS"], "symbol_code": codes["SYMBOL"], "_terminated": codes["TERMINATED"], "source_vector": blank("VECTOR"), "source_coordinate": blank("COORDINATE"),
        "source_decimals": "try_cast(DECIMALS as int)", "source_release_timestamp": "cast(_source_release_timestamp as timestamp_ntz)", "source_archive_sha256": blank("_source_archive_sha256"),
        "_number": "try_cast(VALUE as decimal(24,6))", "cma_code": f"nullif(regexp_extract({blank('DGUID')}, 'S0503([0-9]{{3}})$', 1), '')", **{name: blank(r) for r, name in spec.dimensions},
    }
    prefix = " or ".join(f"startswith(geography, '{p}')" for p in AGGREGATE_PREFIXES)
    second = {
        "geography_level": f"case when cma_code is not null then 'cma' when {prefix} then 'aggregate' else 'other' end",
        "geography_key": "case when cma_code is not null then concat('cma:', cma_code) when geography_dguid is not null then concat('dguid:', geography_dguid) else concat('name:', geography) end",
        "is_revised": either.format("R"), "is_preliminary": either.format("P"), "is_suppressed": either.format("X"),
        "is_terminated": "coalesce(_terminated = 'T' or status_code = 'T' or symbol_code = 'T', false)",
        "is_unavailable": "coalesce(status_code in ('..', '...', 'F') or symbol_code in ('..', '...', 'F'), false)",
        "normalized_value": f"cast(_number * cast(case scalar_id {scale} end as decimal(10,0)) as decimal(35,6))",
    }
    third = {"is_publishable": "normalized_value is not null and not is_suppressed and not is_unavailable", spec.measure: spec.measure_sql, **{n: e for n, _, e in spec.extras}}
    typed = raw.select(*keep, *(F.expr(e).alias(n) for n, e in first.items()))
    typed = typed.withColumns({n: F.expr(e) for n, e in second.items()}).withColumns({n: F.expr(e) for n, e in third.items()})
    publishable = F.col("is_publishable") & F.col(spec.measure).isNotNull()
    return typed.withColumn("is_publishable", publishable).drop("_terminated", "_number")


def project(clean: DataFrame, spec: SourceSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the spec's clean columns, cast to its types."""
    return clean.select(*keep, *(F.col(n).cast(t).alias(n) for n, t in spec.clean_schema))
