"""Units as a graph: affine edges, shortest compositions and a cycle check, exact in fractions."""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import lookup, squeeze


@dataclass(frozen=True)
class Edge:
    """target = scale * source + offset."""

    source: str
    target: str
    scale: Fraction
    offset: Fraction = Fraction(0)

    def inverse(self) -> Edge:
        return Edge(self.target, self.source, 1 / self.scale, -self.offset / self.scale)


class UnitError(ValueError):
    pass


@dataclass(frozen=True)
class UnitGraph:
    """Conversions between units. The graph is a registry written by people, so it lives on the driver."""

    edges: tuple[Edge, ...]

    def compositions(self, target: str) -> dict[str, tuple[Fraction, Fraction, int]]:
        """Of each unit that reaches ``target``: scale, offset and hops of the shortest composition.

        Every edge off the search tree closes a cycle; if its function disagrees with the tree's, UnitError is raised.
        """
        near: dict[str, list[Edge]] = defaultdict(list)
        for e in self.edges:
            if not e.scale:
                raise UnitError(f"{e.source} -> {e.target}: a scale of 0 has no inverse")
            near[e.target].append(e)
            near[e.source].append(e.inverse())
        found = {target: (Fraction(1), Fraction(0), 0)}
        queue = deque([target])
        while queue:
            at = queue.popleft()
            scale, offset, hops = found[at]
            for e in near[at]:
                reached = (scale * e.scale, scale * e.offset + offset)
                if e.source not in found:
                    found[e.source] = (*reached, hops + 1)
                    queue.append(e.source)
                elif found[e.source][:2] != reached:
                    raise UnitError(f"conversions of {e.source} to {target} disagree: {found[e.source][:2]} and {reached}")
        return found

    def table(self, spark: SparkSession, target: str) -> DataFrame:
        """One row per unit: source_unit, target_unit, unit_factor decimal(30,10), unit_offset, hops."""
        rows = [(u, target, _decimal(a), _decimal(b), h) for u, (a, b, h) in sorted(self.compositions(target).items())]
        return spark.createDataFrame(rows, "source_unit string, target_unit string, unit_factor decimal(30,10), unit_offset decimal(30,10), hops int")


def _decimal(x: Fraction):
    from decimal import Decimal, localcontext

    with localcontext() as ctx:
        ctx.prec = 38
        return round(Decimal(x.numerator) / Decimal(x.denominator), 10)


SCALES = {"ten": 1, "hundred": 2, "thousand": 3, "ten_thousand": 4, "hundred_thousand": 5, "million": 6, "billion": 9}
PACKS = {"pair": 2, "dozen": 12}


def dwelling_units() -> UnitGraph:
    """Counts of dwellings: powers of ten chained to each other, packs, and packs counted in powers of ten."""
    edges, last = [], ("unit", 0)
    for name, power in SCALES.items():
        edges.append(Edge(name, last[0], Fraction(10 ** (power - last[1]))))
        last = (name, power)
    edges += [Edge("million", "thousand", Fraction(1000)), Edge("dozen", "pair", Fraction(6))]
    edges += [Edge(pack, "unit", Fraction(n)) for pack, n in PACKS.items()]
    edges += [Edge(f"{pack}*{name}", pack, Fraction(10**power)) for pack in PACKS for name, power in SCALES.items()]
    return UnitGraph(tuple(edges))


# Words and marks by which texts name a unit, and the unit.
UNIT_WORDS = {
    "million": "million", "milliard": "billion", "billion": "billion", "thousand": "thousand", "millier": "thousand", "hundred": "hundred", "centaine": "hundred",
    "ten": "ten", "dizaine": "ten", "dozen": "dozen", "douzaine": "dozen", "pair": "pair", "000": "thousand", "k": "thousand", "10": "ten", "100": "hundred", "1000": "thousand",
}
UNIT_MARK = r"(million|milliard|billion|thousand|millier|hundred|centaine|dozen|douzaine|pair|\bten|dizaine|(?<![0-9])000|\bk\b|[x*×] ?1[ ,]?000\b|[x*×] ?100?\b)"


NO_UNIT = ("", "units", "Units")  # the usual texts name none


def unit_words(c: Column) -> Column:
    """The unit other than a single one that a text names, else null."""
    mark = F.regexp_replace(F.regexp_extract(F.lower(squeeze(c)), UNIT_MARK, 1), "[x*× ,]", "")
    return F.when(~c.isin(*NO_UNIT), lookup(mark, UNIT_WORDS))


def unit_scale(c: Column) -> Column:
    """The unit of a decimal exponent such as SCALAR_ID; 0, null and unknown exponents name none."""
    return F.when(c != "0", lookup(F.trim(squeeze(c)).try_cast("int").cast("string"), {str(p): name for name, p in SCALES.items()}))


NUMBER = r"^([+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+))"


def number_text(c: Column) -> Column:
    """VALUE with blanks squeezed and thousands grouping (commas, blanks between digits) removed."""
    return F.when(c.rlike(r"^[0-9]+\z"), c).otherwise(F.regexp_replace(squeeze(c), r"(?<=[0-9])[, ]+(?=[0-9])", ""))


def read_units(df: DataFrame, value: str = "VALUE", scalar_id: str = "SCALAR_ID", scalar_factor: str = "SCALAR_FACTOR", uom: str = "UOM") -> DataFrame:
    """Add value_number, decimal(24,6), and source_unit, the one unit a row states, wherever it does.

    A value without a leading number has none; scientific notation is no plain number. A unit stated twice counts once,
    nothing stated is 'unit'. A pack and a power of ten together are their product ('dozen*thousand'). Two different
    powers, or two packs, contradict each other: the name joined by '|' is in no graph, so such a row gets no quantity.
    """
    raw, t, said, plain_row = F.col(value), F.col("_text"), F.col("_said"), F.col("_plain")
    # Most rows hold bare digits and state no unit anywhere; they are told apart first and spared all reading.
    silent = [F.coalesce(F.col(c).isin(*names), F.lit(True)) for c, names in ((scalar_id, ("0", "")), (scalar_factor, NO_UNIT), (uom, NO_UNIT))]
    known = df.withColumn("_plain", F.coalesce(raw.rlike(r"^[0-9]{1,18}\z"), F.lit(False)) & silent[0] & silent[1] & silent[2])
    numbered = known.withColumn("_text", F.when(~plain_row, number_text(raw))).withColumn("_number", F.nullif(F.regexp_extract(t, NUMBER, 1), F.lit("")))
    rest = F.regexp_replace(t, NUMBER, "")
    stated = F.array(unit_scale(F.col(scalar_id)), unit_words(F.col(scalar_factor)), unit_words(F.col(uom)), unit_words(rest))
    listed = numbered.withColumn("_said", F.when(~plain_row, F.array_sort(F.array_distinct(F.array_compact(stated)))))
    one = (
        F.when(plain_row | (F.size(said) == 0), F.lit("unit"))
        .when(F.size(said) == 1, said[0])
        .when((F.size(said) == 2) & (F.size(F.array_intersect(said, packs := F.array(*map(F.lit, PACKS)))) == 1), F.concat_ws("*", F.array_intersect(said, packs), F.array_except(said, packs)))
        .otherwise(F.array_join(said, "|"))
    )
    plain = ~t.rlike(NUMBER + r"[eE][+-]?[0-9]")
    number = F.when(plain_row, raw.cast("decimal(24,6)")).when(plain, F.col("_number").try_cast("decimal(24,6)"))
    return listed.withColumns({"value_number": number, "source_unit": one}).drop("_plain", "_text", "_number", "_said")
