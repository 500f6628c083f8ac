"""Mixing sources to target weights, by iterative proportional fitting (raking).

Tokens are summed per cell, a cell being one value of each dimension (source, language, topic).
Cell weights begin as token shares and are scaled until their sums match the target shares of
every dimension. A document is then kept with the probability that gives its cell its weight,
decided by a hash of the row, so that the same rows are kept however often a task runs.

Only the table of cells is iterated over, by window sums; it has a row per combination of values,
not per document, and no list of cells leaves Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.llm.words import BROADCAST_ROWS, carried, n_words, restored, small, whole_text
from outfall.session import settle

#: Sweeps over all dimensions between two writes of the cells, and the most of these rounds.
SWEEPS = 4
ROUNDS = 25
#: The largest relative change of a cell in the last sweep that counts as settled.
TOLERANCE = 1e-6
#: Cells that one task handles.
CELLS_PER_TASK = 100_000
#: The name of a null value in a dimension.
NONE = "(none)"
_BITS = 52


def token_cells(docs: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """``_tokens`` per cell. A document counts as one token at least."""
    tokens = F.greatest(n_words(F.col("text")), F.lit(1))
    return (
        docs.select(*[named(c).alias(d) for d, c in dims.items()], tokens.alias("_t"))
        .groupBy(*dims)
        .agg(F.sum("_t").alias("_tokens"))
    )


def named(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NONE))


def flattened(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares (``dim``, ``_target``) in proportion to the token shares to a power below 1."""
    raised = cells.groupBy(dim).agg(F.pow(F.sum("_tokens").cast("double"), F.lit(power)).alias("_p"))
    return raised.select(dim, (F.col("_p") / raised.agg(F.sum("_p")).scalar()).alias("_target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``cells`` with ``_weight``, the share of all tokens that each cell should have.

    ``targets`` holds a table (dimension, ``_target``) for each dimension. Values that no document
    has are left out and the rest is scaled up; cells whose value has no target get weight 0. When
    no weights meet all targets, the result is that of the last sweep, which meets those of the
    last dimension.
    """
    cells = settle(cells)
    if cells.isEmpty():
        return cells.withColumn("_weight", F.lit(0.0))
    tasks = 1 + cells.count() // CELLS_PER_TASK
    state = cells.withColumn("_weight", F.col("_tokens").cast("double"))
    for i, (dim, table) in enumerate(targets.items()):
        seen = settle(table.join(cells.select(dim).distinct(), dim, "left_semi"))
        share = F.col("_target") / seen.agg(F.sum("_target")).scalar()
        state = state.join(small(seen.select(dim, share.alias(f"_t{i}")), max_rows), dim, "left")
    state = settle(state)
    for _ in range(ROUNDS):
        # In one partition, which is enough for most tables of cells, the windows need no exchange.
        state = state.coalesce(tasks)
        for _ in range(SWEEPS):
            for i, dim in enumerate(targets):
                now = F.sum("_weight").over(Window.partitionBy(dim))
                factor = F.when(now > 0, F.coalesce(f"_t{i}", F.lit(0.0)) / now).otherwise(0.0)
                state = state.withColumn(f"_f{i}", factor).withColumn("_weight", F.col("_weight") * F.col(f"_f{i}"))
        # Once settled, the factors of a sweep are all 1.
        moved = [F.abs(F.col(f"_f{i}") - 1) for i in range(len(targets))]
        state = settle(state.withColumn("_moved", reduce(F.greatest, moved)))
        most = state.filter(F.col("_weight") > 0).agg(F.max("_moved")).first()[0]
        if most is None or most <= TOLERANCE:
            break
    return state.select(*cells.columns, "_weight")


def sampling_rates(cells: DataFrame, budget: float | None = None) -> DataFrame:
    """``cells`` with ``probability``.

    ``budget`` is the number of tokens wanted. Cells that have too few tokens for their weight are kept whole, and what they
    lack is handed on to the others by their weights. Without a budget it is the most that the weights
    allow, with a probability of 1 in the scarcest cell.
    """
    per_token = F.when(F.col("_weight") > 0, F.col("_weight") / F.col("_tokens")).otherwise(0.0)
    rated = settle(cells.withColumn("_rate", per_token))
    if budget is None:
        most = rated.agg(F.max("_rate")).first()[0]
        scale = 1 / most if most else 0.0
    else:
        scale = _scale(rated, float(budget))
    probability = F.when(F.col("_rate") > 0, F.least(F.col("_rate") * F.lit(scale), F.lit(1.0))).otherwise(0.0)
    return rated.withColumn("probability", probability).drop("_rate")


def _scale(rated: DataFrame, budget: float) -> float:
    """By what rates are multiplied so that, none being over 1, they give ``budget`` tokens, or all that there are.

    With every step more cells are whole, so the steps come to an end; each sums the table of cells once.
    """
    scale = 0.0
    while True:
        whole = (F.col("_rate") * F.lit(scale) >= 1) if scale else F.lit(False)
        sums = rated.filter("_rate > 0").agg(
            F.sum(F.when(whole, F.col("_tokens"))).alias("held"), F.sum(F.when(~whole, F.col("_weight"))).alias("open")
        )
        held, left = sums.first()
        if not left:
            return scale or 1.0
        next_scale = max(0.0, budget - (held or 0)) / left
        if next_scale <= scale * (1 + 1e-12):
            return scale
        scale = next_scale


def lot(seed: int) -> Column:
    """A number from 0 to 1 that depends on id and text only."""
    bits = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(1 << _BITS))
    return bits / F.lit(float(1 << _BITS))


def rated(
    docs: DataFrame,
    dims: dict[str, Column],
    targets: dict[str, DataFrame] | float,
    seed: int = 0,
    share: float | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The rows of ``docs`` (``carried``), with ``_mix__tokens`` and ``_mix__weight`` of the cell, ``_mix_probability`` and ``_mix_kept``.

    ``dims`` names the dimensions and their expressions over ``docs``; null is a value of its own.
    ``targets`` are tables of shares, or the power to which token shares are raised. ``share`` is the part
    of all tokens that is wanted (see ``sampling_rates``). Rows that
    repeat id and text share their lot. An empty table gives an empty one.
    """
    held = {f"_cell_{d}": c for d, c in dims.items()}
    cells = settle(token_cells(docs, held))
    if isinstance(targets, dict):
        wanted = {f"_cell_{d}": t.withColumnRenamed(d, f"_cell_{d}") for d, t in targets.items()}
    else:
        wanted = {d: flattened(cells, d, targets) for d in held}
    total = cells.agg(F.sum("_tokens")).first()[0] or 0
    budget = None if share is None else share * total
    rates = settle(sampling_rates(rake(cells, wanted, max_rows), budget))
    rates = rates.select(*held, *[F.col(c).alias(f"_mix_{c}") for c in ("_tokens", "_weight", "probability")])
    return (
        carried(docs, *[named(c).alias(d) for d, c in held.items()])
        .join(small(rates, max_rows), list(held), "left")
        .withColumn("_mix_kept", lot(seed) < F.col("_mix_probability"))
        .drop(*held)
    )


def mix(docs: DataFrame, *args, **options) -> DataFrame:
    """``docs`` with ``_tokens`` and ``_weight`` of the cell, ``probability`` and ``kept``.

    Takes what ``rated`` takes. Columns of ``docs`` with these names are replaced.
    """
    names = ["_tokens", "_weight", "probability", "kept"]
    mine = [F.col(f"_mix_{c}").alias(c) for c in names]
    own = [F.col("_whole").getField(c).alias(c) for c in docs.columns if c not in names]
    return rated(docs, *args, **options).select(*own, *mine)


def sample(docs: DataFrame, *args, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns. Takes what ``rated`` takes."""
    return restored(rated(docs, *args, **options).filter("_mix_kept"))


def content_topic(text: Column) -> Column:
    """A coarse topic that needs no model, by what a text is made of: records, figures, markup, lists or prose.

    Shares are of the characters that are no white space; a text without any is ``empty``.
    """
    text = whole_text(text)
    size = F.length(F.regexp_replace(text, r"\s+", "")).cast("double")
    lines = F.regexp_count(text, F.lit(r"\n")) + 1
    return (
        F.when(size == 0, "empty")
        .when(F.regexp_count(text, F.lit(r"[|\t]")) >= F.lit(0.01) * size, "records")
        .when(F.regexp_count(text, F.lit(r"[0-9]")) >= F.lit(0.08) * size, "figures")
        .when(F.regexp_count(text, F.lit(r"[<>{}\[\]=;#*_$%&@]")) >= F.lit(0.03) * size, "markup")
        .when(size < 40 * lines, "lists")
        .otherwise("prose")
    )
