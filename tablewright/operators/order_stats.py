"""Exact order statistics without sorting a whole group in one task.

Exact medians, quartiles, the n-th smallest hash of an exact-size sample and
the cut points of an exact 60/80 split all ask one question: which value has
rank ``r`` inside its group? The obvious answers do not scale: ``percentile``
keeps a value->count map of the whole group in one task, a global
``row_number`` or ``orderBy().limit(n)`` sends every row through one task.

One path serves every size. A rank is found by narrowing a bracket:

1. per bracket, an approximate quantile grid (``percentile_approx``, a
   bounded sketch, merged map-side) over the rows still in the bracket;
2. one counting pass tells which grid interval holds rank ``r``. Rows below
   the interval are added to ``below``; if ``r`` falls on an interval end,
   the value is known; otherwise the bracket becomes the open interval.
   Both passes work per bracket, not per target: the brackets of a group are
   disjoint, so a row is placed in the one that holds it by its group's
   sorted bracket ends, and is never copied per target.

Each round shrinks a bracket about ``GRID/3``-fold, whatever the skew; a value
that fills a whole bracket (heavy ties) is resolved by the counts at once.
A bracket of at most ``max_rows`` rows (from the start, for a small group) is
finished with a window sort over those rows only. ``max_rows`` decides how
many rounds there are, never a value: the answer is the data value of that
rank either way, and interpolation is one expression for all. Correctness
does not depend on the sketch's error bound, only the number of rounds does.
The per-round target table is small (one row per group and rank),
checkpointed to the shared folder, and broadcast only while its bytes are
within ``BROADCAST_BYTES``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT_ROWS = 1_000_000      # rows (16 MB) a single task may sort to finish a bracket
GRID = 1000                 # grid intervals per round
ACCURACY = 10 * GRID        # sketch accuracy: rank error < one tenth of a grid step
BROADCAST_BYTES = 8 << 20   # largest target table sent to every task
TARGET_BYTES = 128          # bytes of one target: bracket, probes, row overhead

_GRID_PROBS = [i / GRID for i in range(GRID + 1)]


def _checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder. The frame is persisted
    first so that the checkpoint write does not compute it a second time."""
    from tablewright.session import shared_dir
    shared_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = kept.checkpoint(eager=True)
    kept.unpersist()
    return out


def _leading(array: str, holds, most: int) -> Column:
    """How many elements of ``array`` come before the first for which ``holds``
    is not true; once it is not, it is for none after it. A binary search over
    up to ``most`` elements: the cost of a row grows with their logarithm."""
    steps = [1 << b for b in reversed(range(max(1, most).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= F.size(array)) & holds(F.get(array, at + step - 1)), at + step).otherwise(at))


def _attach(base: DataFrame, brackets: DataFrame, by: list[str], small: bool, most: int) -> DataFrame:
    """Each row of ``base`` with the bracket that holds its ``_v`` (``lo``,
    ``hi`` and the other columns of ``brackets``); rows in no bracket go.

    One row per group carries the group's brackets as a sorted array; the
    last bracket that begins below the value is the only one that can hold
    it, and is found by a binary search. ``small``: the bracket table may be
    broadcast; otherwise the join is shuffled, and a hot group's partition
    split by adaptive execution. ``most``: brackets of a group, at most."""
    rest = [c for c in brackets.columns if c not in by]
    packed = brackets.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi", *[c for c in rest if c not in ("lo", "hi")])))
        .alias("_tw_b"))
    joined = base.join(F.broadcast(packed) if small else packed, by, "inner")
    v = F.col("_v")
    at = _leading("_tw_b", lambda b: b["lo"].isNull() | (b["lo"] < v), most)
    joined = joined.withColumn("_tw_h", F.get("_tw_b", at - 1)).drop("_tw_b")
    hi = F.col("_tw_h.hi")
    return (joined.filter(F.col("_tw_h").isNotNull() & (hi.isNull() | (v < hi)))
            .select(*base.columns, *[F.col(f"_tw_h.{c}").alias(c) for c in rest]))


def _join_same(left: DataFrame, right: DataFrame, by: list[str],
               nullable: list[str]) -> DataFrame:
    """Inner equi-join of two small per-bracket tables on the group columns
    and the bracket ends (null = unbounded, matched null-safely)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in by + nullable else F.col(c)
                       for c in right.columns])
    cond = ([left[c] == r[f"_r_{c}"] for c in by]
            + [left[c].eqNullSafe(r[f"_r_{c}"]) for c in nullable])
    return left.join(r, cond, "inner").drop(*[f"_r_{c}" for c in by + nullable])


def _finished(base: DataFrame, targets: DataFrame, keys: list[str], extra: list[str], by: list[str],
              value: str, small: bool) -> DataFrame:
    """The wanted ranks of groups that one task each may sort: a row number in
    the group, joined with the targets. Without a round there is nothing to
    store between rounds."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_v"))
    ranked = base.select(*by, F.col("_v").alias("_picked"), rank.cast("bigint").alias("_rn"))
    want = targets.select(*keys, *extra, F.col("rank").alias("_rn"))
    picked = _join_same(F.broadcast(want) if small else want, ranked, by + ["_rn"], [])
    return picked.select(*keys, *extra, F.col("_picked").alias(value))


def select_ranks(base: DataFrame, value: str, targets: DataFrame,
                 by: list[str] | tuple = (), max_rows: int = EXACT_ROWS) -> DataFrame:
    """Value of rank ``rank`` (1-based, ascending) per target.

    ``base``: rows with the ``by`` columns and a non-null ``value``.
    ``targets``: the ``by`` columns, ``tid`` (any id), ``rank`` (1 <= rank
    <= n) and ``n`` (rows in the group); other columns are carried through.
    Returns the target columns plus ``value``.
    """
    if not by:
        # one group: its key is 0 for every row, computed, as a literal key
        # would turn the joins below into nested loops
        one = F.pmod(F.xxhash64(value), F.lit(1)).cast("int").alias("_tw_g")
        return select_ranks(base.select("*", one), value,
                            targets.select("*", F.lit(0).alias("_tw_g")), ["_tw_g"],
                            max_rows).drop("_tw_g")
    by = list(by)
    keys = by + ["tid", "rank"]
    extra = [c for c in targets.columns if c not in keys + ["n"]]
    vtype = base.schema[value].dataType
    v = F.col(value)
    base = base.select(*by, v.alias("_v"))
    state = targets.select(
        *by, "tid", F.col("rank").cast("bigint").alias("rank"),
        F.lit(None).cast(vtype).alias("lo"), F.lit(None).cast(vtype).alias("hi"),
        F.lit(0).cast("bigint").alias("below"),
        F.col("n").cast("bigint").alias("m"),
        F.lit(None).cast(vtype).alias("answer"),
        *extra)
    # the target table is small (one row per group and rank); keep it for
    # the rounds below and learn its size and largest bracket in one job
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    info = state.agg(F.count(F.lit(1)).alias("t"), F.max("m").alias("mx")).collect()[0]
    n_targets, biggest = info["t"], info["mx"] or 0
    if n_targets == 0:
        state.unpersist()
        return state.select(*keys, *extra, F.col("answer").alias(value))
    small = n_targets * TARGET_BYTES <= BROADCAST_BYTES
    if biggest <= max_rows:     # every group is one bracket, finished at once
        state.unpersist()
        return _finished(base, state, keys, extra, by, value, small)
    carried = state.select(*keys, *extra) if extra else None
    first = state
    state = _checkpoint(state.drop(*extra))
    if carried is not None:
        carried = _checkpoint(carried)
    first.unpersist()
    bracket = ["lo", "hi"]

    grid = F.array(*[F.lit(p) for p in _GRID_PROBS])
    while biggest > max_rows:
        open_big = state.filter(F.col("answer").isNull() & (F.col("m") > max_rows))
        # Work is done per bracket, not per target: targets of one group
        # share a bracket (in the first round, the whole group), so a row is
        # attached to each distinct bracket holding it, once.
        brackets = open_big.select(*by, *bracket).distinct()
        # 1. approximate grid of the rows inside each bracket
        cand = _attach(base, brackets, by, small, n_targets)
        sketch = cand.groupBy(*by, *bracket).agg(
            F.percentile_approx("_v", grid, ACCURACY).alias("_tw_grid"))
        q = (F.col("rank") - F.col("below")) / F.col("m")
        i_lo = F.greatest(F.floor(q * GRID) - 1, F.lit(0)).cast("int")
        i_hi = F.least(F.ceil(q * GRID) + 1, F.lit(GRID)).cast("int")
        probe = (_join_same(open_big, sketch, by, bracket)
                 .withColumn("plo", F.get(F.col("_tw_grid"), i_lo))
                 .withColumn("phi", F.get(F.col("_tw_grid"), i_hi))
                 .drop("_tw_grid"))
        # 2. one counting pass: the probe values of all targets in a bracket cut
        #    it into cells, open intervals and single values; rows per cell
        probes = _checkpoint(probe.groupBy(*by, *bracket).agg(F.array_sort(F.array_distinct(F.concat(
            F.collect_list("plo"), F.collect_list("phi")))).alias("_tw_p")))
        cand = _attach(base, probes, by, small, n_targets)
        x = F.col("_v")
        cells = cand.withColumn("_lt", _leading("_tw_p", lambda p: p < x, 2 * n_targets))
        on = F.get("_tw_p", F.col("_lt")) == x          # the probes are distinct
        cells = cells.withColumn("_le", F.col("_lt") + F.when(on, 1).otherwise(0)).groupBy(
            *by, *bracket, "_lt", "_le").agg(F.count(F.lit(1)).alias("_c"))
        # each target's rank falls into one cell: a single value answers it, an
        # interval becomes its bracket. Brackets of a group stay disjoint.
        order = Window.partitionBy(*by, *bracket).orderBy("_lt", "_le")
        cells = cells.withColumn("_upto", F.sum("_c").over(order))
        ends = _join_same(cells, probes, by, bracket)
        one = F.col("_le") > F.col("_lt")
        ends = ends.select(
            *by, *bracket, "_c", "_upto",
            F.when(~one, F.when(F.col("_lt") > 0, F.get("_tw_p", F.col("_lt") - 1)).otherwise(F.col("lo"))).alias("_nlo"),
            F.when(~one, F.coalesce(F.get("_tw_p", F.col("_lt")), F.col("hi"))).alias("_nhi"),
            F.when(one, F.get("_tw_p", F.col("_lt"))).alias("_is"))
        t = F.col("rank") - F.col("below")
        nxt = (_join_same(open_big, ends, by, bracket)
               .filter((F.col("_upto") >= t) & (F.col("_upto") - F.col("_c") < t))
               .select(*keys, F.col("_nlo").alias("lo"), F.col("_nhi").alias("hi"),
                       (F.col("below") + F.col("_upto") - F.col("_c")).alias("below"),
                       F.col("_c").alias("m"), F.col("_is").cast(vtype).alias("answer")))
        done = state.join(nxt.select(*keys), keys, "left_anti")
        # lineage is cut once per round
        state = _checkpoint(done.unionByName(nxt))
        biggest = state.filter(F.col("answer").isNull()).agg(F.max("m")).collect()[0][0] or 0

    # 3. finish every open bracket (now at most max_rows rows) with one sort
    #    per bracket; the wanted ranks are picked by a join with the (small,
    #    checked) target table on the bracket and the row number
    open_small = state.filter(F.col("answer").isNull())
    brackets = open_small.select(*by, *bracket, "below").distinct()
    cand = _attach(base, brackets, by, small, n_targets)
    w = Window.partitionBy(*by, *bracket).orderBy(F.col("_v"))
    ranked = cand.select(*by, *bracket, F.col("_v").alias("_picked"),
                         F.row_number().over(w).alias("_rn"))
    want = open_small.select(*keys, *bracket, (F.col("rank") - F.col("below")).alias("_rn"))
    if small:
        want = F.broadcast(want)
    picked = _join_same(want, ranked, by + ["_rn"], bracket).select(*keys, "_picked")
    out = (state.join(picked, keys, "left")
           .select(*keys, F.coalesce("answer", "_picked").alias(value)))
    if carried is not None:
        out = out.join(carried, keys, "inner")
    return out


def exact_quantiles(df: DataFrame, value: str, probs: list[float],
                    by: list[str] | tuple = (), kind: str | list[str] = "cont",
                    max_rows: int = EXACT_ROWS) -> DataFrame:
    """Exact quantiles of ``value`` per group, nulls skipped.

    ``kind="cont"``: linear interpolation at position 1 + (n-1)p, as Spark
    ``percentile``/``median``, DuckDB ``quantile_cont``, R type 7, numpy.
    ``kind="disc"``: the value of rank ceil(p*n), a real data value, as
    ``approxQuantile(c, [p], 0)`` and DuckDB ``quantile_disc``. A list gives
    one kind per probability; all are answered by the same passes.

    Returns ``by``, ``p``, ``kind``, ``q``: one row per group and p.
    """
    by = list(by)
    kinds = [kind] * len(probs) if isinstance(kind, str) else list(kind)
    # the passes below read group and value only; held for them, so that what
    # ``df`` stands for (a join, a cleaning) is computed once
    base = df.select(*by, F.col(value).cast("double").alias("_x")).filter(
        F.col("_x").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _checkpoint(_quantiles(base, probs, kinds, by, max_rows))
    finally:
        base.unpersist()


def _quantiles(base: DataFrame, probs: list[float], kinds: list[str], by: list[str],
               max_rows: int) -> DataFrame:
    counts = base.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    specs = []
    n = F.col("n")
    for i, (p, k) in enumerate(zip(probs, kinds)):
        head = [F.lit(i).alias("pid"), F.lit(float(p)).alias("p"), F.lit(k).alias("kind")]
        if k == "disc":
            r = F.greatest(F.ceil(F.lit(float(p)) * n), F.lit(1)).cast("bigint")
            specs += [F.struct(*head, r.alias("rank"), F.lit(0.0).alias("frac"),
                               F.lit(0).alias("part"))]
        else:
            h = F.lit(1.0) + (n - 1) * F.lit(float(p))
            fl = F.floor(h).cast("bigint")
            frac = h - fl
            specs += [F.struct(*head, fl.alias("rank"), frac.alias("frac"),
                               F.lit(0).alias("part")),
                      F.struct(*head, F.least(fl + 1, n).cast("bigint").alias("rank"),
                               frac.alias("frac"), F.lit(1).alias("part"))]
    targets = (counts.select(*by, "n", F.explode(F.array(*specs)).alias("s"))
               .select(*by, "n", "s.*"))
    targets = targets.withColumn("tid", F.col("pid") * 2 + F.col("part"))
    rows = select_ranks(base, "_x", targets, by=by, max_rows=max_rows)
    out = rows.groupBy(*by, "pid", "p", "kind").agg(
        F.max(F.when(F.col("part") == 0, F.col("_x"))).alias("v0"),
        F.max(F.when(F.col("part") == 1, F.col("_x"))).alias("v1"),
        F.max("frac").alias("frac"))
    q = F.when(F.col("v1").isNull(), F.col("v0")).otherwise(
        F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac"))
    return out.select(*by, "p", "kind", q.alias("q"))


def exact_column_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                           kind: str = "cont", max_rows: int = EXACT_ROWS) -> DataFrame:
    """Exact quantiles of several numeric columns (nulls skipped), long form
    (column, p, kind, q): the columns as groups of one selection, so all share
    its passes."""
    if not columns:
        raise ValueError("no columns")
    long = df.select(F.posexplode(F.array(*[F.col(c).try_cast("double") for c in columns]))
                     .alias("_tw_c", "x"))
    q = exact_quantiles(long, "x", probs, by=["_tw_c"], kind=kind, max_rows=max_rows)
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_tw_c") + 1)
    return q.select(name.alias("column"), "p", "kind", "q")


def first_k_conditions(df: DataFrame, order: list[str], ks: list[int],
                       n: int | None = None, max_rows: int = EXACT_ROWS) -> list:
    """Row conditions, one per ``k`` in ``ks``, each true for exactly the
    ``k`` rows that come first in ascending ``order`` (numeric columns
    without nulls, the tuple unique per row). Replaces
    ``orderBy(order).limit(k)`` and a global ``row_number``, which funnel
    rows through one task: all cut values are found by one ``select_ranks``
    (one number per cut reaches the driver), then rows are kept by plain
    comparisons that are pushed down and spread over all tasks. Ties on an
    order column are split by the next one."""
    n = df.count() if n is None else n
    conds: list = [None] * len(ks)
    inner = []
    for i, k in enumerate(ks):
        if k <= 0:
            conds[i] = F.lit(False)
        elif k >= n:
            conds[i] = F.lit(True)
        else:
            inner.append((i, int(k)))
    if not inner:
        return conds
    head, rest = order[0], order[1:]
    targets = df.sparkSession.createDataFrame(
        [(i, k, n) for i, k in inner], "tid int, rank bigint, n bigint")
    cuts = {r["tid"]: r["_o"] for r in
            select_ranks(df.select(F.col(head).alias("_o")), "_o", targets,
                         max_rows=max_rows).collect()}
    if rest:
        c = df.agg(*[F.count_if(F.col(head) < F.lit(cuts[i])).alias(f"b{i}") for i, _ in inner],
                   *[F.count_if(F.col(head) == F.lit(cuts[i])).alias(f"t{i}") for i, _ in inner]
                   ).collect()[0]
    for i, k in inner:
        before = F.col(head) < F.lit(cuts[i])
        on_cut = F.col(head) == F.lit(cuts[i])
        if not rest:
            conds[i] = before | on_cut
            continue
        need, ties = k - c[f"b{i}"], c[f"t{i}"]
        if need >= ties:          # the whole tie group fits: no finer cut
            conds[i] = before | on_cut
        else:
            finer = first_k_conditions(df.filter(on_cut), rest, [need], n=ties,
                                       max_rows=max_rows)[0]
            conds[i] = before | (on_cut & finer)
    return conds


def first_k_condition(df: DataFrame, order: list[str], k: int,
                      n: int | None = None, max_rows: int = EXACT_ROWS):
    """``first_k_conditions`` for a single ``k``."""
    return first_k_conditions(df, order, [k], n, max_rows)[0]
