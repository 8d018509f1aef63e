"""Problem 6: rows that fail to parse, split from the valid ones with the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut, small

HOLD, ESCAPE = "\u0001", "\u0002"
MAX_DICTIONARY_BYTES = 32_000_000


@dataclass(frozen=True)
class Check:
    """A column's values: ``typed``, SQL over ``value``, casts one (null if it can't); only values of a given ``form`` count,
    for a cast reads more than a strict record may hold; ``codes`` stand for values without being any."""

    reason: str
    typed: str
    form: str
    codes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Layout:
    """Columns of one source's lines and the checks of some of them, in order."""

    source: str
    columns: tuple[str, ...]
    checks: dict[str, Check]


def _outside_ok(part: Column, first: Column, last: Column) -> Column:
    """What stands between quoted stretches: nothing (a doubled quote), or text that starts and ends at a comma."""
    empty = part == ""
    return F.when(first & last, F.lit(True)).when(first, empty | part.endswith(",")).when(last, empty | part.startswith(",")).otherwise(empty | (part.startswith(",") & part.endswith(",")))


def with_csv_fields(lines: DataFrame, line: str) -> DataFrame:
    """Add ``fields`` and ``quoting_ok`` of one strict CSV record. Fields come unquoted.

    Lines without a quote, and lines with all fields quoted and no quote within, are cut at once; their quotes are counted
    to tell them apart. Any other is split at its quotes: odd pieces are quoted, even ones are not. No regular expression
    walks a line, so its length and number of quotes don't matter.
    """
    text, parts, whole, count = F.col(line), F.col("_parts"), F.col("_whole"), F.col("_count")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    inner = F.split(F.substring(text, F.lit(2), F.length(text) - 2), '","', -1)
    split = lines.withColumn("_quotes", quotes).withColumn("_whole", F.when(F.col("_quotes") == 0, F.split(text, ",", -1)).when(text.startswith('"') & text.endswith('"') & (F.col("_quotes") % 2 == 0), inner))
    easy = whole.isNotNull() & ((F.col("_quotes") == 0) | (F.col("_quotes") == 2 * F.size(whole)))
    split = split.withColumn("_easy", F.coalesce(easy, F.lit(False)))
    safe = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "b")), F.lit(HOLD), F.lit(ESCAPE + "a"))
    split = split.withColumn("_parts", F.when(~F.col("_easy"), F.split(safe, '"', -1))).withColumn("_count", F.size(parts))
    flags = F.transform(parts, lambda p, i: (i % 2 == 1) | _outside_ok(p, i == 0, i == count - 1))
    held = F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.replace(p, F.lit(","), F.lit(HOLD))).otherwise(p))

    def plain(f: Column) -> Column:
        bare = F.when(f.startswith('"'), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f)
        back = F.replace(F.replace(F.replace(bare, F.lit(HOLD), F.lit(",")), F.lit(ESCAPE + "a"), F.lit(HOLD)), F.lit(ESCAPE + "b"), F.lit(ESCAPE))
        return F.when(f.contains('"') | f.contains(HOLD) | f.contains(ESCAPE), back).otherwise(f)

    hard = F.transform(F.split(F.array_join(held, '"'), ",", -1), plain)
    return split.withColumns({
        "fields": F.when(F.col("_easy"), whole).otherwise(hard), "quoting_ok": F.when(F.col("_easy"), True).otherwise((count % 2 == 1) & F.forall(flags, lambda f: f)),
    }).drop("_quotes", "_whole", "_easy", "_parts", "_count")


def _dictionary(held: DataFrame, layouts: tuple[Layout, ...], columns: list[str]) -> DataFrame:
    """Cast each distinct value of each checked column once: (source, column, value, reason) of those that fail."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_k{i}").alias("value")) for i, c in enumerate(columns)))
    distinct = held.filter("shape_reason is null").select("source", F.explode(pairs).alias("p")).select("source", "p.*").dropna(subset=["value"]).distinct()
    reason = F.lit(None).cast("string")
    for lay in layouts:
        for col, check in lay.checks.items():
            sound = F.expr(check.typed).isNotNull() & F.col("value").rlike(rf"^(?:{check.form})\z")
            if check.codes:
                sound = F.col("value").isin(*check.codes) | sound
            mine = (F.col("source") == lay.source) & (F.col("column") == col)
            reason = F.when(mine & ~F.coalesce(sound, F.lit(False)), F.lit(check.reason)).otherwise(reason)
    return distinct.withColumn("reason", reason).filter("reason is not null")


def checked_lines(lines: DataFrame, layouts: tuple[Layout, ...], line: str = "line", source: str = "source_id", with_fields: bool = True) -> DataFrame:
    """The columns of ``lines`` other than the text, ``fields`` (array; null without ``with_fields``) and ``reason``: null if valid, else the first check failed.

    Order of checks: quoting, column_count, then the layout's columns in its order. A null line has no columns
    (column_count), as has a line of a source without layout. Spaces (U+0020) around checked values don't matter.
    Lines are cut into fields once; what later steps need is kept by a checkpoint. The dictionary of invalid values is
    joined back column by column; it is broadcast only if few and short, else AQE's skew join splits hot values.
    """
    need, columns = F.lit(None).cast("int"), list({c: None for lay in layouts for c in lay.checks})
    for lay in layouts:
        need = F.when(F.col(source) == lay.source, F.lit(len(lay.columns))).otherwise(need)
    others = [c for c in lines.columns if c not in (line, "fields", "reason")]
    parsed = with_csv_fields(lines, line)
    shape = F.when(~F.col("quoting_ok"), "quoting").when(~F.coalesce(F.size("fields") == need, F.lit(False)), "column_count")
    values = {}
    for i, col in enumerate(columns):
        value = F.lit(None).cast("string")
        for lay in layouts:
            if col in lay.checks:
                value = F.when(F.col(source) == lay.source, F.trim(F.get("fields", F.lit(lay.columns.index(col))))).otherwise(value)
        values[f"_k{i}"] = F.when(F.col("shape_reason").isNull(), value)
    fields = F.col("fields") if with_fields else F.lit(None).cast("array<string>")
    held = cut(parsed.withColumn("shape_reason", shape).select(*others, F.col(source).alias("source"), fields.alias("fields"), "shape_reason", *(v.alias(k) for k, v in values.items())))
    bad = cut(_dictionary(held, layouts, columns))
    out, reason = held, F.col("shape_reason")
    for i, col in enumerate(columns):
        words = small(bad.filter(F.col("column") == col).select(F.col("source").alias(f"_s{i}"), F.col("value").alias(f"_v{i}"), F.col("reason").alias(f"_r{i}")), max_bytes=MAX_DICTIONARY_BYTES)
        out = out.join(words, (F.col("source") == F.col(f"_s{i}")) & (F.col(f"_k{i}") == F.col(f"_v{i}")), "left")
        reason = F.coalesce(reason, F.col(f"_r{i}"))
    return out.select(*others, "fields", reason.alias("reason"))


def valid_records(checked: DataFrame, layout: Layout, keep: tuple[str, ...] = ()) -> DataFrame:
    """The valid lines of one source as named columns (strings; checked values trimmed)."""
    mine = checked.filter(F.col("reason").isNull() & (F.col("source_id") == layout.source))
    cols = [(F.trim(F.col("fields")[i]) if c in layout.checks else F.col("fields")[i]).alias(c) for i, c in enumerate(layout.columns)]
    return mine.select(*keep, *cols)
