"""Ordered computations per key that stay balanced when one key holds most rows.

A window over a key runs in one task. Before building the plan, a count and, on big
inputs, a hash sample of the rows tell which keys are too heavy for that. Without such a
key the plan is the plain window. A heavy key's ordered rows are cut into segments, the
window runs per (key, segment), and a small carry joins the segments again. Results never
depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

SEG = "_segment"
CUT = "_is_cut"
_COARSE = "_coarse"
_PER_COARSE = 128
from holdfast.plans.nested import nested
from holdfast.session import staged


@dataclass(frozen=True)
class Split:
    """When to cut a key.

    About ``samples`` rows are sampled at most and every ``per_segment`` of one key start
    a segment, so the driver sees, and the plan broadcasts, at most
    ``samples / per_segment`` cut positions, however big the input. Keys below about
    twice ``min_rows`` rows stay whole.
    """

    min_rows: int = 2_000_000
    samples: int = 2_000_000
    per_segment: int = 50

    def rate(self, total: int) -> int:
        """One row in this many is sampled."""
        return max(1, self.min_rows // self.per_segment, total // self.samples)


DEFAULT_SPLIT = Split()


def _listed(names: Sequence[str]) -> str:
    return ", ".join(names)


def _earlier(order: Sequence[str], bound: str) -> str:
    """Whether row r's order values come before those of a bound struct."""
    *head, last = order
    test = f"r.{last} < {bound}.{last}"
    for c in reversed(head):
        test = f"(r.{c} < {bound}.{c} OR (r.{c} = {bound}.{c} AND {test}))"
    return test


def cut_points(rows: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split = DEFAULT_SPLIT) -> DataFrame | None:
    """Segments of the heavy keys: (keys, segment, coarse segment, from, to); None without any.

    Reads a row count and at most ``samples / per_segment`` positions to the driver, so
    that every branch of the plan and every retried task uses the same cuts.
    """
    total = rows.count()
    if total < 2 * split.min_rows:
        return None
    k, o = _listed(keys), _listed(order)
    # get() counts from 0 and is null outside the array, which leaves the ends open.
    cuts = rows.sparkSession.sql(
        nested(
            f"""
            SELECT {k}, {SEG}, {SEG} div {_PER_COARSE} AS {_COARSE}, get(cuts, {SEG} - 1) AS _from, get(cuts, {SEG}) AS _to
            FROM (SELECT {k}, cuts, explode(sequence(0, size(cuts))) AS {SEG} FROM @heavy)
            """,
            sampled=f"SELECT {k}, struct({o}) AS at FROM {{rows}} WHERE pmod(xxhash64({k}, {o}), {split.rate(total)}L) = 0",
            per_key="SELECT {k}, sort_array(collect_list(at)) AS s FROM @sampled GROUP BY {k}".format(k=k),
            heavy=f"""
              SELECT {k}, filter(s, (x, i) -> i > 0 AND i % {split.per_segment} = 0) AS cuts
              FROM @per_key WHERE size(s) >= {2 * split.per_segment}
            """,
        ),
        rows=rows,
    )
    found = cuts.collect()
    return rows.sparkSession.createDataFrame(found, cuts.schema) if found else None


def with_segments(rows: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame) -> DataFrame:
    """Adds the segment of each row (0 for a key left whole) and whether its key is cut.

    Two joins, coarse then fine, keep the number of ranges tried per row small. The hints
    are safe: the cuts are bounded, see Split.
    """
    def inside(side: str) -> str:
        same = " AND ".join(f"r.{k} <=> {side}.{k}" for k in keys)
        after = f"({side}._from IS NULL OR NOT ({_earlier(order, side + '._from')}))"
        before = f"({side}._to IS NULL OR {_earlier(order, side + '._to')})"
        return f"{same} AND {after} AND {before}"

    return rows.sparkSession.sql(
        nested(
            f"""
            SELECT /*+ BROADCAST(c, f) */ r.*, coalesce(f.{SEG}, 0) AS {SEG}, f.{SEG} IS NOT NULL AS {CUT}
            FROM {{rows}} r
            LEFT JOIN @coarse c ON {inside('c')}
            LEFT JOIN {{cuts}} f ON f.{_COARSE} <=> c.{_COARSE} AND {inside('f')}
            """,
            coarse=f"""
              SELECT {_listed(keys)}, {_COARSE}, min_by(_from, {SEG}) AS _from, max_by(_to, {SEG}) AS _to
              FROM {{cuts}} GROUP BY {_listed(keys)}, {_COARSE}
            """,
        ),
        rows=rows,
        cuts=cuts,
    )


def segmented(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    where: str | None = None,
    source: DataFrame | None = None,
    split: Split = DEFAULT_SPLIT,
) -> tuple[DataFrame, list[str], bool]:
    """Rows with their segment, the columns to group by beside it, and whether any key is cut.

    Rows outside ``where`` (column ``_in`` false) leave their key and spread by hash.
    ``source`` gives the cut points from a cheaper frame with the same key and order
    columns; any source is right, one with a similar spread is balanced.
    """
    test = f"coalesce({where}, false)" if where else "true"
    group = [*[f"_key_{k}" for k in keys], "_salt"]
    keyed = [f"CASE WHEN {test} THEN {k} END AS {g}" for k, g in zip(keys, group)]
    salt = f"CASE WHEN NOT {test} THEN pmod(xxhash64({_listed(order)}), 4096L) END AS _salt"
    work = df.selectExpr("*", f"{test} AS _in", *keyed, salt)
    if source is None:
        sampled = work.where("_in").selectExpr(*group, *order)
    else:
        sampled = source.selectExpr(*[f"{k} AS {g}" for k, g in zip(keys, group)], "CAST(NULL AS bigint) AS _salt", *order)
    cuts = cut_points(sampled, group, order, split)
    if cuts is None:
        return work.selectExpr("*", f"0 AS {SEG}"), group, False
    # The rows are read twice from here on; derived ones are stored, not computed again.
    if source is not None:
        work = staged(work, "rows")
    return with_segments(work, group, order, cuts), group, True


def lag_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int,
    out: str,
    where: str | None = None,
    source: DataFrame | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """``value`` of the row ``n`` places earlier among the key's rows satisfying ``where``."""
    work, group, cut = segmented(df, keys, order, where, source, split)
    g, o = _listed(group), _listed(order)
    if not cut:
        lagged = f"CASE WHEN _in THEN lag({value}, {n}) OVER (PARTITION BY {g} ORDER BY {o}) END AS {out}"
        return work.selectExpr(*df.columns, lagged)
    same = " AND ".join(f"w.{c} <=> c.{c}" for c in (*group, SEG))
    # At most n rows per segment are tails; a segment's first tail row sees the n before it.
    return df.sparkSession.sql(
        nested(
            f"""
            SELECT /*+ BROADCAST(c) */ {_listed(['w.' + c for c in df.columns])},
              CASE WHEN NOT w._in THEN NULL WHEN w._rank > {n} THEN w._lag
                   ELSE get(c._before, size(c._before) + w._rank - {n} - 1).v END AS {out}
            FROM @local w LEFT JOIN @carry c ON {same}
            """,
            tails=f"""
              SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY {g}, {SEG} ORDER BY {_listed([c + ' DESC' for c in order])}) AS _back
                FROM {{work}} WHERE {CUT} AND _in
              ) WHERE _back <= {n}
            """,
            carry=f"""
              SELECT {g}, {SEG}, _before FROM (
                SELECT {g}, {SEG},
                  collect_list(struct({value} AS v)) OVER (PARTITION BY {g} ORDER BY {SEG}, {o} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS _before,
                  lag({SEG}) OVER (PARTITION BY {g} ORDER BY {SEG}, {o}) AS _previous
                FROM @tails
              ) WHERE _previous <> {SEG}
            """,
            local=f"""
              SELECT *,
                lag({value}, {n}) OVER (PARTITION BY {g}, {SEG} ORDER BY {o}) AS _lag,
                row_number() OVER (PARTITION BY {g}, {SEG} ORDER BY {o}) AS _rank
              FROM {{work}}
            """,
        ),
        work=work,
    )


_COMBINE = {
    "max": "greatest({a}, {b})",
    "min": "least({a}, {b})",
    "sum": "coalesce({a} + {b}, {b}, {a})",
}


def running_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    how: str,
    out: str,
    source: DataFrame | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Running max, min or sum of ``value`` over the key's ordered rows, row included."""
    work, group, cut = segmented(df, keys, order, None, source, split)
    g, o = _listed(group), _listed(order)
    if not cut:
        return work.selectExpr(*df.columns, f"{how}({value}) OVER (PARTITION BY {g} ORDER BY {o} ROWS UNBOUNDED PRECEDING) AS {out}")
    same = " AND ".join(f"w.{c} <=> c.{c}" for c in (*group, SEG))
    return df.sparkSession.sql(
        nested(
            f"""
            SELECT /*+ BROADCAST(c) */ {_listed(['w.' + c for c in df.columns])},
              {_COMBINE[how].format(a='c._before', b='w._local')} AS {out}
            FROM @local w LEFT JOIN @carry c ON {same}
            """,
            totals=f"SELECT {g}, {SEG}, {how}({value}) AS _part FROM {{work}} WHERE {CUT} GROUP BY {g}, {SEG}",
            carry=f"""
              SELECT {g}, {SEG},
                {how}(_part) OVER (PARTITION BY {g} ORDER BY {SEG} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before
              FROM @totals
            """,
            local=f"""
              SELECT *, {how}({value}) OVER (PARTITION BY {g}, {SEG} ORDER BY {o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _local
              FROM {{work}}
            """,
        ),
        work=work,
    )
