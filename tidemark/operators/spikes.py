"""Problem 7: spikes, stuck values and impossible readings, each series judged by its own behaviour."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wavelet levels whose details are added up: a month beside the 2**LEVELS - 1 months before it, and after it.
LEVELS, PERIOD = 3, 12
#: The chance at which a series of normal scatter may have one month marked; the threshold follows from it.
SERIES_ERROR = 0.05
#: Whole numbers scatter by themselves: a spike lies beyond so many Poisson deviations too.
POISSON_DEVIATIONS = 3.0
#: A median absolute deviation tells the scatter as well as the standard deviation of this share of as many values.
MAD_EFFICIENCY = 0.37
LEAST_COUNTS, STUCK_MONTHS, STUCK_LEAST = 6, 6, 10
TURNS, ROUNDS, CHUNK = 3, 40, 4_000_000


def t_quantiles(freedom: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Student's t that is exceeded with chance ``tail``, by integrating its density for each whole number of degrees of freedom."""
    x = np.sinh(np.linspace(0, 9, 9001))
    out = np.empty(len(freedom))
    for f in np.unique(freedom):
        density = (1 + x * x / f) ** (-(f + 1) / 2)
        area = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2 * np.diff(x))])
        mine = freedom == f
        out[mine] = np.interp(0.5 - tail[mine], area / area[-1] / 2, x)
    return out


def _median(values: np.ndarray, axis: int) -> np.ndarray:
    """Median along an axis without NaNs; NaN if there is nothing else."""
    values = np.moveaxis(values, axis, 0)
    known, ordered = (~np.isnan(values)).sum(axis=0)[None], np.sort(values, axis=0)
    low, high = (np.take_along_axis(ordered, i, axis=0)[0] for i in (np.maximum(known - 1, 0) // 2, np.minimum(known // 2, len(values) - 1)))
    return (low + high) / 2


def _shift(x: np.ndarray, by: int) -> np.ndarray:
    """x[:, t - by], 0 before the first."""
    out = np.zeros_like(x)
    if by < x.shape[1]:
        out[:, by:] = x[:, : x.shape[1] - by]
    return out


def haar_side(z: np.ndarray, use: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """The undecimated Haar details of levels 1 to ``levels`` added up, rows being series: how far each month lies from the
    mean of the 2**levels - 1 months before it (only where ``use``). Where all these are missing, further levels are added.
    NaN if nothing comes before.

    The transform is à trous: each level's smooth is the mean of the last one's at two months, twice as far apart as
    before. Sums and weights are carried apart, so gaps weigh nothing.
    """
    own = np.where(use, np.nan_to_num(z), 0.0)
    total, weight, level = own.copy(), use.astype(float), 0
    out = np.full(z.shape, np.nan)
    while True:
        total, weight, level = total + _shift(total, 1 << level), weight + _shift(weight, 1 << level), level + 1
        if level >= levels:
            others = weight - use
            fresh = np.isnan(out) & (others > 0)
            out[fresh] = (z - (total - own) / np.maximum(others, 1))[fresh]
            if (1 << level) >= z.shape[1]:
                return out


def smaller_side(z: np.ndarray, use: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(detail, before, after): the transform run forwards and backwards, and the smaller of the two where their signs agree, else 0.

    A month for itself alone stands out on both sides, a lasting change of level on one only. At an end there is but one side.
    """
    before, after = haar_side(z, use, levels), haar_side(z[:, ::-1], use[:, ::-1], levels)[:, ::-1]
    a, b = np.where(np.isnan(before), after, before), np.where(np.isnan(after), before, after)
    least = np.where(np.abs(a) < np.abs(b), a, b)
    return np.nan_to_num(np.where(a * b > 0, least, 0.0)), before, after


def _level(z: np.ndarray, use: np.ndarray, reach: int) -> np.ndarray:
    """Mean of the months up to ``reach`` on either side; NaN where there are none."""
    n = z.shape[1]
    total, count = (np.pad(np.cumsum(x, axis=1), ((0, 0), (1, 0))) for x in (np.where(use, np.nan_to_num(z), 0.0), use.astype(float)))
    lo, hi = np.maximum(np.arange(n) - reach, 0), np.minimum(np.arange(n) + reach + 1, n)
    some = count[:, hi] - count[:, lo]
    return np.where(some > 0, (total[:, hi] - total[:, lo]) / np.maximum(some, 1), np.nan)


def seasons(y: np.ndarray, use: np.ndarray, period: int = PERIOD) -> np.ndarray:
    """What a month's place in the year adds: the median, over the other years, of how far that month lies from the level around it.

    A month never enters its own season, so a spike stays whole. Level and season are fitted in turn. The number of columns
    must be a multiple of ``period``.
    """
    rows, n = y.shape
    season = np.zeros(y.shape)
    for _ in range(TURNS):
        apart = np.where(use, y - _level(y - season, use, period // 2), np.nan).reshape(rows, n // period, period)
        years = apart.shape[1]
        if years < 2:
            return season
        season = np.nan_to_num(np.stack([_median(np.delete(apart, k, axis=1), 1) for k in range(years)], axis=1)).reshape(rows, n)
    return season


def detail_scores(x: np.ndarray, skip: np.ndarray | None = None, period: int = PERIOD) -> np.ndarray:
    """Scores of dense monthly series, one a row (NaN: no count): above 1 in size is a spike, the sign tells its direction.

    log(x + 1) less its season goes through an undecimated Haar transform forwards and backwards; a month's detail is the
    smaller of the two sides. It is scaled by the median absolute deviation of the series' own details (at least what
    rounding to whole numbers makes), and compared with the Student quantile that a normal month of the series passes with
    a chance of SERIES_ERROR over the number of months, at the degrees of freedom such a scale has. It must also lie
    POISSON_DEVIATIONS from the likely count. Months that are found are left out and the rest transformed again, the
    clearest first, all being judged anew each time, so one spike neither hides nor marks another month. ``skip``
    marks months that are judged elsewhere, and left out from the start.
    """
    rows, n = x.shape
    wide = -(-max(n, 1) // period) * period
    count = np.full((rows, wide), np.nan)
    count[:, :n] = np.where(x >= 0, x, np.nan)
    if skip is not None:
        count[:, :n][skip] = np.nan
    score = np.zeros((rows, wide))
    with np.errstate(invalid="ignore"):
        y = np.log1p(count)
        known = ~np.isnan(y)
        spare = np.zeros(y.shape, bool)
        live = np.flatnonzero(known.sum(axis=1) >= LEAST_COUNTS)
        for _ in range(ROUNDS):
            if not len(live):
                break
            one, out = y[live], spare[live]
            use = known[live] & ~out
            detail, before, after = smaller_side(one - seasons(one, use, period), use)
            shown = np.concatenate([np.where(use, before, np.nan), np.where(use, after, np.nan)], axis=1)
            months = use.sum(axis=1)
            rounding = 1 / np.sqrt(12) / (np.exp(_median(np.where(use, one, np.nan), 1)) + 1e-9)
            scale = np.fmax(1.4826 * _median(np.abs(shown), 1), rounding)
            # Within a series tails go by the months judged.
            freedom = np.maximum(np.round(MAD_EFFICIENCY * months), 3).astype(int)
            limit = t_quantiles(freedom, SERIES_ERROR / 2 / np.maximum(months, 1))
            likely = np.maximum(np.expm1(one - detail), 0)
            poisson = 2 * np.abs(np.sqrt(np.where(known[live], count[live], 0) + 0.375) - np.sqrt(likely + 0.375))
            now = np.where(known[live], np.sign(detail) * np.minimum(np.abs(detail) / (scale * limit)[:, None], poisson / POISSON_DEVIATIONS), 0.0)
            now = np.nan_to_num(now)
            high = np.abs(now) > 1
            # Of candidates within two months or in the same month of other years, which may be each other's shadow, the
            # one that also stands out from its own surroundings most comes first.
            plain = smaller_side(one, use, 2)[0]
            rank = np.where(high & ~out, np.where(detail * plain > 0, np.minimum(np.abs(detail), np.abs(plain)), 0) + 1e-3 * np.abs(detail), 0)
            near = np.max([_shift(rank, k) for k in range(3)] + [_shift(rank[:, ::-1], k)[:, ::-1] for k in (1, 2)], axis=0)
            yearly = np.tile(rank.reshape(len(live), -1, period).max(axis=1), wide // period)
            first = (rank > 0) & (rank >= np.maximum(near, yearly)) & (rank >= rank.max(axis=1, keepdims=True) / 2)
            after_now = (high & out) | first
            score[live] = np.where(after_now | ~high, now, 0.0)
            spare[live] = after_now
            live = live[(after_now != out).any(axis=1)]
    return score[:, :n]


def stuck_runs(x: np.ndarray, months: int = STUCK_MONTHS, least: int = STUCK_LEAST) -> np.ndarray:
    """True within runs of ``months`` or more periods whose Haar differences are all zero, at a level of ``least`` up."""
    out = np.zeros(len(x), bool)
    if not len(x):
        return out
    moved = np.flatnonzero(np.concatenate([[True], ~(np.diff(x) == 0)]))
    for a, b in zip(moved, np.append(moved[1:], len(x)), strict=True):
        if b - a >= months and x[a] >= least:
            out[a:b] = True
    return out


def flag_series(begins: np.ndarray, times: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[int], list[int], list[str], list[float]]:
    """(row, month number, flag, score) of every implausible month of series with times from ``begins`` on."""
    rows, at, why, scores = [], [], [], []
    lengths = np.array([int(t.max() - b) + 1 if len(t) else 0 for t, b in zip(times, begins, strict=True)])
    # Series of like length go together, as many as fit.
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    while len(order):
        widest = lengths[order]
        some = max(1, int(np.searchsorted(np.arange(1, len(order) + 1) * widest * np.maximum(widest // PERIOD, 1), CHUNK, "right")))
        part, order = order[:some], order[some:]
        x = np.full((len(part), lengths[part[-1]]), np.nan)
        for i, r in enumerate(part):
            x[i, times[r] - begins[r]] = values[r]
        stuck = np.stack([stuck_runs(row) for row in x])
        score = detail_scores(x, stuck)
        with np.errstate(invalid="ignore"):
            i, j = np.nonzero((x < 0) | stuck | (np.abs(score) > 1))
        rows += part[i].tolist()
        at += (begins[part[i]] + j).tolist()
        why += np.where(x[i, j] < 0, "impossible", np.where(stuck[i, j], "stuck", "spike")).tolist()
        scores += score[i, j].tolist()
    return rows, at, why, scores


def _flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("points")
        offsets, flat = lists.offsets.to_numpy(), lists.flatten()
        t, v = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64), flat.field(1).to_numpy(zero_copy_only=False).astype(float)
        cuts = (offsets - offsets[0])[1:-1]
        times, values = np.split(t, cuts), np.split(v, cuts)
        begins = np.array([int(x.min()) if len(x) else 0 for x in times], np.int64)
        index, at, why, score = flag_series(begins, times, values)
        same = batch.drop_columns(["points"]).take(pa.array(index, pa.int64()))
        yield pa.RecordBatch.from_arrays([*same.columns, pa.array(at, pa.int32()), pa.array(why, pa.string()), pa.array(score, pa.float64())], names=[*same.schema.names, "month_no", "flag", "score"])


def implausible_months(df: DataFrame, entity: Sequence[str], time: str, value: str, latest: Sequence[str] = ()) -> DataFrame:
    """entity, ref_month, flag (impossible, stuck, spike) and score of every implausible month.

    Repeats of a month count once (where they differ, the greatest by ``latest``); null counts and missing months are
    gaps. Rows without a time are dropped, nulls in the entity form an entity, an empty table gives no rows. Series of
    fewer than six counts have no scatter of their own, so no spikes. Repeats are aggregated before series are
    gathered, so a series holds one point per calendar month at most, however many rows it has.
    """
    month_no = F.year(time) * 12 + F.month(time) - 1
    once = (
        df.select(*entity, month_no.cast("int").alias("t"), F.struct(*latest, F.col(value).cast("double").alias("v")).alias("r"))
        .dropna(subset=["t"])
        .groupBy(*entity, "t")
        .agg(F.max("r")["v"].alias("v"))
    )
    # A fixed number of partitions, for AQE would merge what is small in bytes, though the transform is heavy.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    series = once.groupBy(*entity).agg(F.collect_list(F.struct("t", "v")).alias("points")).repartition(parts, F.xxhash64(*entity))
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{e}` {fields[e]}" for e in entity) + ", month_no int, flag string, score double"
    flagged = series.mapInArrow(_flag, schema)
    name = F.format_string("%04d-%02d", F.floor(F.col("month_no") / 12), F.col("month_no") % 12 + 1)
    return flagged.select(*entity, name.alias("ref_month"), "flag", "score")
