"""Problem 5: filling containers of fixed capacity with texts of varying length.

Hierarchical multi-length packing. A container of ``capacity`` tokens is cut into
context windows of several lengths: the whole of it, a quarter, a sixteenth.

1. Each text (or the rest of a text that is longer than a container, after its full
   pieces are cut off) is routed to the tier of the shortest window that holds it.
2. Each tier's own texts are packed into windows of its length. Where short windows
   would cost containers, because too few small texts are left to fill them, a tier's
   texts are packed into the next longer windows instead.
3. Before the next tier is packed, the gaps of these windows are filled with the
   largest texts of shorter tiers that fit, widest gaps first.
4. Windows are laid side by side, long tiers first, so that no window crosses the
   end of a container. Containers are dealt to step groups in serpentine order of
   tier and fill, which balances their tokens and their long windows.

The plan needs only how many texts there are of each size: at most
``capacity`` numbers for each container size, whatever the corpus. The driver
plans *patterns* (which sizes share a window) with multiplicities; each text
finds its window from its rank among the texts of its size. Ranks come from
salted groups, so a size that half the corpus has is no hot task.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.tokens import TOKENIZERS, VOCABULARY, token_count
from pairloom.storage import materialize, spread

#: More container sizes than this are refused; their plans are held on the driver.
MOST_SPECS = 1000
#: Each tier's window is this part of the one before; windows shorter than ``SHORTEST`` tokens are not cut.
FACTOR, TIERS, SHORTEST = 4, 3, 32


def windows(capacity: int) -> list[int]:
    """Lengths of the windows of each tier, long ones first."""
    return [capacity, *(capacity // FACTOR**t for t in range(1, TIERS) if capacity // FACTOR**t >= SHORTEST)]


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(number of containers, [(size, pieces of it in each container), ..]), ..].

    The largest size left opens a container and the largest sizes that still fit
    fill it; the pattern is repeated as often as all its sizes last. Every
    pattern uses up a size or leaves less of it than one container takes, so
    there are about as many patterns as sizes.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    order = sorted(left)
    plan = []
    while order:
        gap, pattern, at = capacity, [], len(order)
        while at > 0 and gap > 0:
            at = min(at, bisect.bisect_right(order, gap))
            if at == 0:
                break
            s = order[at - 1]
            k = min(gap // s, left[s])
            pattern.append((s, k))
            gap -= k * s
            at -= 1
        times = min(left[s] // k for s, k in pattern)
        plan.append((times, pattern))
        for s, k in pattern:
            left[s] -= times * k
            if not left[s]:
                del left[s]
                order.pop(bisect.bisect_left(order, s))
    return plan


def fill_gaps(plan: list[tuple[int, list[tuple[int, int]]]], window: int, shorter: dict[int, int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """``plan`` with the gaps of its windows filled from ``shorter`` (size -> texts), which loses what is used.

    Widest gaps come first, and the largest sizes that fit. Each step ends a
    pattern or uses up a size.
    """
    order = sorted(s for s, n in shorter.items() if n > 0)
    out = []
    for times, pattern in sorted(plan, key=lambda x: sum(s * k for s, k in x[1])):
        room = window - sum(s * k for s, k in pattern)
        while times:
            gap, more, at = room, [], len(order)
            while at > 0 and gap > 0:
                at = min(at, bisect.bisect_right(order, gap))
                if at == 0:
                    break
                s = order[at - 1]
                k = min(gap // s, shorter[s])
                more.append((s, k))
                gap -= k * s
                at -= 1
            now = min([times, *(shorter[s] // k for s, k in more)])
            out.append((now, pattern + more))
            times -= now
            for s, k in more:
                shorter[s] -= now * k
                if not shorter[s]:
                    order.pop(bisect.bisect_left(order, s))
    return out


Plan = list[tuple[int, list[tuple[int, int]]]]


def plan_tiers(counts: dict[int, int], capacity: int, ladder: tuple[int, ...] | None = None) -> list[Plan]:
    """For each tier [(number of windows, [(size, texts of it in each window), ..]), ..], fullest windows first.

    ``ladder`` has for each tier the tier whose windows it is packed into, its own if it is not given.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    lengths = windows(capacity)
    out = []
    for tier, shorter in enumerate([*lengths[1:], 0]):
        window = lengths[ladder[tier] if ladder else tier]
        own = {s: left.pop(s) for s in list(left) if s > shorter}
        plan = fill_gaps(plan_patterns(own, window), window, left)
        out.append(sorted(plan, key=lambda x: -sum(s * k for s, k in x[1])))
    return out


def best_plan(counts: dict[int, int], capacity: int, slack: float = 0.002) -> tuple[tuple[int, ...], list[Plan]]:
    """(ladder, plan): the one with the shortest windows of those that need hardly more containers than the best."""
    n = len(windows(capacity))
    ladders = [tuple(min(t, longest) for t in range(n)) for longest in range(n - 1, -1, -1)]
    tried = [(ladder, plan_tiers(counts, capacity, ladder)) for ladder in ladders]
    need = [-(-sum(times * FACTOR ** (n - 1 - w) for w, plan in zip(ladder, tiers) for times, _ in plan) // FACTOR ** (n - 1)) for ladder, tiers in tried]
    return next(t for t, k in zip(tried, need) if k <= (1 + slack) * min(need))


def lay_out(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Runs of pieces: size, first_rank, last_rank, window_tier, first_unit, span, per_window, used, run.

    A unit is the window of the shortest tier, ``span`` the units of a window;
    ``run`` numbers the patterns in the order of their units.
    """
    lengths = windows(capacity)
    rank: dict[int, int] = {}
    rows, unit, run = [], 0, 0
    for tier, plan in zip(*best_plan(counts, capacity)):
        span = FACTOR ** (len(lengths) - 1 - tier)
        for times, pattern in plan:
            used = sum(s * k for s, k in pattern)
            for s, k in pattern:
                a = rank.get(s, 0)
                rows.append((s, a, a + times * k - 1, tier, unit, span, k, used, run, unit + times * span))
                rank[s] = a + times * k
            unit += times * span
            run += 1
    return pd.DataFrame(rows, columns=["size", "first_rank", "last_rank", "window_tier", "first_unit", "span", "per_window", "used", "run", "end"])


def tokens_before(runs: pd.DataFrame, units: np.ndarray) -> np.ndarray:
    """Tokens of all windows that begin before each unit."""
    once = runs.drop_duplicates("run").sort_values("run")
    first, span, used, end = (once[c].to_numpy("int64") for c in ("first_unit", "span", "used", "end"))
    before = np.concatenate([[0], np.cumsum((end - first) // span * used)])[:-1]
    i = np.searchsorted(first, units, side="right") - 1
    inside = np.minimum(units, end[i]) - first[i]
    return before[i] + -(-inside // span[i]) * used[i]


def sized(documents: DataFrame, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (), folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, tokens, ..) of each row, counted once and written to the shared folder."""
    return materialize(spread(documents.select(id_col, *keep, text)).select(id_col, *keep, token_count(F.col(text), folder, vocabulary).alias("tokens")), "token-sizes")


def pieces(sizes: DataFrame, specs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(spec_id, capacity, id, tokens, piece, start, size): whole texts, or the pieces of those that exceed a container."""
    rows = specs.limit(MOST_SPECS + 1).collect()
    if len(rows) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} container sizes")
    largest: dict[int, int] = {}
    for r in rows:
        if r[0] is not None and r[1] is not None and r[1] > 0:
            largest[int(r[0])] = max(int(r[1]), largest.get(int(r[0]), 0))
    listed = sorted(largest.items())
    each = F.array(*[F.struct(F.lit(s).alias("spec_id"), F.lit(c).cast("long").alias("capacity")) for s, c in listed]) if listed else F.expr("cast(array() as array<struct<spec_id:int,capacity:bigint>>)")
    row = sizes.where("tokens > 0").select(id_col, "tokens", F.explode(each).alias("s")).select(id_col, "tokens", "s.*")
    return row.select(
        "spec_id", "capacity", id_col, "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("capacity")))).alias("piece")
    ).withColumn("start", F.col("piece") * F.col("capacity")).withColumn("size", F.least(F.col("capacity"), F.col("tokens") - F.col("start")))


def pack(documents: DataFrame, specs: DataFrame, text: str = "text", id_col: str = "doc_id", per_step: int = 8, rows_per_salt: int = 500_000, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Where each text lies, for each container size.

    ``specs`` has (spec_id, capacity_tokens). Columns: spec_id, container_id,
    the id, piece, start_token, piece_tokens, tier, window_tier, window,
    window_tokens, space_left, step_group.

    A text is split only if it exceeds the capacity. Null and blank texts have no
    tokens and lie nowhere: they have no row. Rows of equal id are different
    texts. Capacities that are null or not positive are left out; of a spec_id that is
    listed again the largest capacity counts. Empty tables give an empty result.
    ``tier`` is the piece's own (0: only the whole container holds it), ``window_tier``
    that of the window it lies in, never a shorter one; ``window`` numbers the windows
    of a container, ``window_tokens`` is their length, ``space_left`` is of the
    container. ``per_step`` containers make a step group.
    """
    spark = documents.sparkSession
    kind = documents.schema[id_col].dataType.simpleString()
    sizes = sized(documents, text, id_col, folder=folder, vocabulary=vocabulary)
    all_pieces = pieces(sizes, specs.select("spec_id", "capacity_tokens"), id_col)
    salts = max(1, -(-sizes.count() // rows_per_salt))
    all_pieces = all_pieces.withColumn("salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(salts)).cast("int"))
    counts = materialize(all_pieces.groupBy("spec_id", "capacity", "size", "salt").count(), "size-counts")
    # One row for each size that occurs: at most the sum of the capacities.
    histogram: dict[tuple[int, int], dict[int, int]] = {}
    for r in counts.groupBy("spec_id", "capacity", "size").agg(F.sum("count").alias("n")).collect():
        histogram.setdefault((r.spec_id, r.capacity), {})[r.size] = r.n
    runs = {k: lay_out(h, k[1]).sort_values(["size", "first_rank"], kind="stable") for k, h in histogram.items()}
    shared = spark.sparkContext.broadcast(runs)  # as many rows as sizes, some more where a size serves several patterns

    before = F.sum("count").over(Window.partitionBy("spec_id", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("spec_id", "size", "salt", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("spec_id", "size", "salt").orderBy(id_col, "piece")) - 1
    ranked = all_pieces.withColumn("within", within).join(offsets, ["spec_id", "size", "salt"]).withColumn("rank", F.col("offset") + F.col("within"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = {}
        for (spec, capacity), t in shared.value.items():
            a = {c: t[c].to_numpy("int64") for c in t.columns}
            width = int(a["last_rank"].max()) + 2
            tables[spec] = (t, a, width, a["size"] * width + a["first_rank"], capacity)
        for pdf in batches:
            out = []
            for spec, part in pdf.groupby("spec_id"):
                t, a, width, keys, capacity = tables[spec]
                lengths = np.array(windows(capacity))
                units = FACTOR ** (len(lengths) - 1)
                groups = -(-int(a["end"].max()) // (units * per_step))
                size, rank = part["size"].to_numpy("int64"), part["rank"].to_numpy("int64")
                i = np.searchsorted(keys, size * width + rank, side="right") - 1
                unit = a["first_unit"][i] + (rank - a["first_rank"][i]) // a["per_window"][i] * a["span"][i]
                container = unit // units
                filled = tokens_before(t, (container + 1) * units) - tokens_before(t, container * units)
                turn, at = container // groups, container % groups
                out.append(
                    pd.DataFrame(
                        {
                            "spec_id": spec,
                            "container_id": container,
                            id_col: part[id_col].to_numpy(),
                            "piece": part["piece"].to_numpy("int64"),
                            "start_token": part["start"].to_numpy("int64"),
                            "piece_tokens": size,
                            "tier": (np.searchsorted(-lengths, -size, side="right") - 1).astype("int32"),
                            "window_tier": a["window_tier"][i].astype("int32"),
                            "window": unit % units // a["span"][i],
                            "window_tokens": lengths[a["window_tier"][i]],
                            "space_left": capacity - filled,
                            "step_group": np.where(turn % 2 == 0, at, groups - 1 - at),
                        }
                    )
                )
            yield pd.concat(out) if out else pd.DataFrame()

    schema = f"spec_id int, container_id bigint, `{id_col}` {kind}, piece bigint, start_token bigint, piece_tokens bigint, tier int, window_tier int, window bigint, window_tokens bigint, space_left bigint, step_group bigint"
    return ranked.select("spec_id", id_col, "piece", "start", "size", "rank").mapInPandas(place, schema)


def utilisation(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, containers, tokens, fill, step_groups, spread) for each container size; ``spread`` is the
    difference in tokens between the fullest and the emptiest complete step group."""
    per = packed.groupBy("spec_id", "container_id", "step_group").agg(F.sum("piece_tokens").alias("t"))
    group = per.groupBy("spec_id", "step_group").agg(F.sum("t").alias("tokens"), F.count(F.lit(1)).alias("containers"))
    full = Window.partitionBy("spec_id")
    group = group.withColumn("full", F.col("containers") == F.max("containers").over(full))
    total = group.groupBy("spec_id").agg(
        F.sum("containers").alias("containers"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("step_groups"), (F.max(F.when(F.col("full"), F.col("tokens"))) - F.min(F.when(F.col("full"), F.col("tokens")))).alias("spread")
    )
    capacities = specs.groupBy("spec_id").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return total.join(capacities, "spec_id").select("spec_id", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"), "step_groups", "spread")


def audit(packed: DataFrame, specs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(spec_id, texts, overfull_containers, overfull_windows, misrouted, token_difference) of each container size.

    ``sizes`` has the tokens of each text. All but ``texts``, the number of texts that
    have a place, should be 0: containers and windows above their length, pieces in
    a window shorter than their tier's, and tokens of the texts that lie nowhere or twice.
    """
    capacities = specs.where("capacity_tokens > 0").groupBy("spec_id").agg(F.max("capacity_tokens").alias("capacity"))
    per_window = packed.groupBy("spec_id", "container_id", "window_tier", "window", "window_tokens").agg(
        F.sum("piece_tokens").alias("t"), F.count_if(F.col("piece") == 0).alias("texts"), F.count_if(F.col("window_tier") > F.col("tier")).alias("misrouted")
    )
    per = per_window.groupBy("spec_id", "container_id").agg(*[F.sum(c).alias(c) for c in ("t", "texts", "misrouted")], F.count_if(F.col("t") > F.col("window_tokens")).alias("windows"))
    each = per.join(capacities, "spec_id").groupBy("spec_id").agg(
        F.sum("texts").alias("texts"), F.count_if(F.col("t") > F.col("capacity")).alias("overfull_containers"), F.sum("windows").alias("overfull_windows"), F.sum("misrouted").alias("misrouted"), F.sum("t").alias("t")
    )
    whole = sizes.agg(F.sum("tokens")).first()[0] or 0
    return each.select("spec_id", "texts", "overfull_containers", "overfull_windows", "misrouted", (F.lit(whole) - F.col("t")).alias("token_difference"))
