"""Beta distributions as columns: probabilities, quantiles and comparisons by Gauss-Legendre panels.

All integrals run over the log-odds t = ln(x / (1 - x)), where the density of any Beta distribution is
smooth.  It is cut into panels about as wide as its spread, with longer ones for the tails, and a panel
has eight nodes.  Everything stays on the row: no shuffle, no Python.
"""

from __future__ import annotations

import numpy as np
from numpy.polynomial import legendre
from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.scalars import let

_POINTS, _WEIGHTS = legendre.leggauss(8)
#: nodes and weights on (0, 1)
NODES, WEIGHTS = ((_POINTS + 1) / 2).tolist(), (_WEIGHTS / 2).tolist()


def _up_to_nodes() -> list[list[float]]:
    """Row i: the weights by which values at the nodes make the integral from 0 to node i, times weight i."""
    basis = np.linalg.inv(legendre.legvander(_POINTS, 7))
    integral = [legendre.legval(_POINTS, legendre.legint(basis[:, j], lbnd=-1)) / 2 for j in range(8)]
    return (np.array(WEIGHTS)[:, None] * np.array(integral).T).tolist()


WITHIN = _up_to_nodes()
#: panel bounds in spreads around the mode, and of the tails in units that fall by e
CORE = [1.25 * i for i in range(-8, 9)]
TAIL = [10.0 * i for i in range(1, 5)]
#: where the log-odds scale bends, whatever the distribution
BENDS = [-8.0, -4.0, -2.0, -1.0, 0.0, 1.0, 2.0, 4.0, 8.0]


def _numbers(values: list) -> Column:
    """Literal numbers as an array, or lists of them as an array of arrays."""

    def text(v) -> str:
        return f"array({', '.join(map(text, v))})" if isinstance(v, list) else f"{float(v)!r}D"

    return F.expr(text(values))


def density(a: Column, b: Column, u: Column) -> Column:
    """The density at ``u`` log-odds from the mode, over that at the mode.

    Written from the mode, nothing large cancels, so parameters may be of any size.
    """
    n = a + b
    left = a * u - n * F.log1p(a / n * F.expm1(u))
    right = -b * u - n * F.log1p(b / n * F.expm1(-u))
    return F.exp(F.when(u <= 0, left).otherwise(right))


def bounds(a: Column, b: Column) -> Column:
    """Panel bounds, in any order, over all but a vanishing part (below e**-40) of the distribution."""
    mode, spread = F.log(a / b), F.sqrt(1.0 / a + 1.0 / b)
    core = F.transform(_numbers(CORE), lambda c: mode + spread * c)
    low = F.transform(_numbers(TAIL), lambda t: mode - spread * 10.0 - t / a)
    high = F.transform(_numbers(TAIL), lambda t: mode + spread * 10.0 + t / b)
    return F.concat(low, core, high)


# arrays and lambdas rather than a term for each node: a plan of thousands of terms is slow to make


def _at_nodes(a: Column, b: Column, start: Column, width: Column) -> Column:
    """Densities at the nodes of a panel that starts ``start`` from the mode, an array."""
    return F.transform(_numbers(NODES), lambda c: density(a, b, start + width * c))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def _mass(a: Column, b: Column, start: Column, width: Column) -> Column:
    return width * _dot(_numbers(WEIGHTS), _at_nodes(a, b, start, width))


def prob_greater(a1: Column, b1: Column, a2: Column, b2: Column) -> Column:
    """P(Beta(a2, b2) > Beta(a1, b1)) over panels that serve both distributions."""
    bends = _numbers(BENDS)
    points = F.array_sort(F.concat(bounds(a1, b1), bounds(a2, b2), bends))
    fixed = F.struct(
        a1.alias("a1"), b1.alias("b1"), F.log(a1 / b1).alias("m1"),
        a2.alias("a2"), b2.alias("b2"), F.log(a2 / b2).alias("m2"), points.alias("points"),
    )

    def over(d: Column) -> Column:
        def panel(i: Column) -> Column:
            lo = F.get(d.points, i - 1)
            h = F.get(d.points, i) - lo
            first, second = _at_nodes(d.a1, d.b1, lo - d.m1, h), _at_nodes(d.a2, d.b2, lo - d.m2, h)
            return F.struct(first.alias("f1"), second.alias("f2"), h.alias("h"))

        def add(state: Column, p: Column) -> Column:
            within = F.transform(_numbers(WITHIN), lambda row: _dot(row, p.f1))
            inner = _dot(p.f2, within)
            m1, m2 = p.h * _dot(_numbers(WEIGHTS), p.f1), p.h * _dot(_numbers(WEIGHTS), p.f2)
            return F.struct(
                (state.below + m1).alias("below"),
                (state.total + m2).alias("total"),
                (state.wins + state.below * m2 + p.h * p.h * inner).alias("wins"),
            )

        start = F.struct(F.lit(0.0).alias("below"), F.lit(0.0).alias("total"), F.lit(0.0).alias("wins"))
        panels = F.transform(F.sequence(F.lit(1), F.size(d.points) - 1), panel)
        share = lambda s: F.least(F.lit(1.0), s.wins / (s.below * s.total))
        return F.aggregate(panels, start, add, share)

    return let(fixed, over)


def _with_panels(a: Column, b: Column, body) -> Column:
    """``body`` of a, b, mode and the panels (start and width from the mode, mass) of Beta(a, b)."""
    bends = _numbers(BENDS)
    fixed = F.struct(a.alias("a"), b.alias("b"), F.log(a / b).alias("m"), F.array_sort(F.concat(bounds(a, b), bends)).alias("points"))

    def over(d: Column) -> Column:
        def panel(i: Column) -> Column:
            lo = F.get(d.points, i - 1)
            h = F.get(d.points, i) - lo
            return F.struct((lo - d.m).alias("u"), h.alias("h"), _mass(d.a, d.b, lo - d.m, h).alias("mass"))

        return let(F.transform(F.sequence(F.lit(1), F.size(d.points) - 1), panel), lambda panels: body(d, panels))

    return let(fixed, over)


def _total(panels: Column) -> Column:
    return F.aggregate(panels, F.lit(0.0), lambda s, p: s + p.mass)


def cdf(x: Column, a: Column, b: Column) -> Column:
    """P(Beta(a, b) <= x), the regularised incomplete beta function; for 0 < x < 1, else 0 or 1."""

    def below(d: Column, panels: Column) -> Column:
        u = F.log(x / (1.0 - x)) - d.m

        def part(s: Column, p: Column) -> Column:
            cut = F.when(u >= p.u + p.h, p.mass).when(u <= p.u, 0.0).otherwise(_mass(d.a, d.b, p.u, u - p.u))
            return s + cut

        return F.aggregate(panels, F.lit(0.0), part) / _total(panels)

    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(_with_panels(a, b, below))


def quantiles(shares: list[float], a: Column, b: Column, steps: int = 16) -> Column:
    """The x with P(Beta(a, b) <= x) = share, an array: the panel that holds it, then Newton's steps in it."""

    def found(d: Column, panels: Column) -> Column:
        def one(wanted: Column) -> Column:
            def walk(s: Column, p: Column) -> Column:
                here = s.at.isNull() & (s.upto + p.mass >= wanted)
                at = F.struct(p.u.alias("u"), p.h.alias("h"), (wanted - s.upto).alias("rest"), p.mass.alias("mass"))
                return F.struct((s.upto + p.mass).alias("upto"), F.when(here, at).otherwise(s.at).alias("at"))

            none = F.lit(None).cast("struct<u:double,h:double,rest:double,mass:double>")
            start = F.struct(F.lit(0.0).alias("upto"), none.alias("at"))

            def newton(s: Column) -> Column:
                # lo and hi keep the answer between them; a step that leaves them goes to their middle
                def step(k: Column, _: Column) -> Column:
                    over = _mass(d.a, d.b, s.u, k.u - s.u) - s.rest

                    def moved(over: Column) -> Column:
                        lo, hi = F.when(over < 0, k.u).otherwise(k.lo), F.when(over < 0, k.hi).otherwise(k.u)
                        nearer = k.u - over / density(d.a, d.b, k.u)
                        fits = (nearer >= lo) & (nearer <= hi)
                        return F.struct(lo.alias("lo"), hi.alias("hi"), F.when(fits, nearer).otherwise((lo + hi) / 2.0).alias("u"))

                    return let(over, moved)

                first = s.u + s.h * s.rest / s.mass
                begin = F.struct(s.u.alias("lo"), (s.u + s.h).alias("hi"), first.alias("u"))
                count = F.sequence(F.lit(1), F.lit(steps))
                return F.aggregate(count, begin, step, lambda k: 1.0 / (1.0 + F.exp(-(k.u + d.m))))

            return let(F.aggregate(panels, start, walk, lambda s: s.at), newton)

        return let(_total(panels), lambda total: F.transform(_numbers(shares), lambda share: one(total * share)))

    return _with_panels(a, b, found)
