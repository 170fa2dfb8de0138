"""Login and order patterns over time.

Event times are whole seconds.  A user or order may own a large share of all
rows, so no operator puts a whole key into one task: sequences are cut into
fixed time slices, and what one slice must know of its neighbour is passed on.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens import outcomes
from shoplens.operators.windows import floor_div

CHUNK_S = 600


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Every row ``times`` times; written in two steps so no array grows with the data."""
    step = 10_000
    blocks = F.sequence(F.lit(0).cast("bigint"), floor_div(F.col(times) - 1, step))
    left = F.least(F.lit(step).cast("bigint"), F.col(times) - F.col("_block") * step)
    return (
        df.where(F.col(times) > 0)
        .withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))
        .drop("_block", "_copy")
    )


# --- P1: failures counted in a window anchored at the first failure -----------------------------


def _login_seconds(logins: DataFrame, tie: str) -> DataFrame:
    """One row per user and second: failures before the first success (``head``),
    whether there was a success, and failures after the last one (``tail``).

    Failures between two successes of one second never count.  Order within the
    second is settled from minima and maxima; only seconds in which failures and
    successes interleave go back to the rows.
    """
    fail, success = F.col("login_state").eqNullSafe("fail"), ~F.col("login_state").eqNullSafe("fail")
    seconds = logins.groupBy("user_id", "timestamp").agg(
        F.count_if(fail).alias("n"),
        F.min(F.when(fail, F.col(tie))).alias("f_min"), F.max(F.when(fail, F.col(tie))).alias("f_max"),
        F.min(F.when(success, F.col(tie))).alias("s_min"), F.max(F.when(success, F.col(tie))).alias("s_max"),
    )
    inside = lambda c: (F.col(c) > F.col("f_min")) & (F.col(c) < F.col("f_max"))
    mixed = F.coalesce((F.col("n") > 1) & (inside("s_min") | inside("s_max")), F.lit(False))
    none = F.lit(0).cast("bigint")
    head = F.when(F.col("s_min").isNull() | (F.col("f_max") < F.col("s_min")), F.col("n")).otherwise(none)
    tail = F.when(F.col("f_min") > F.col("s_max"), F.col("n")).otherwise(none)
    plain = seconds.where(~mixed).select(
        "user_id", "timestamp", head.alias("head"), F.col("s_min").isNotNull().alias("success"), tail.alias("tail"))
    edges = seconds.where(mixed).select("user_id", "timestamp", "s_min", "s_max")
    between = (
        logins.where(fail).select("user_id", "timestamp", tie)
        .join(edges, ["user_id", "timestamp"])
        .groupBy("user_id", "timestamp")
        .agg(F.count_if(F.col(tie) < F.col("s_min")).alias("head"), F.lit(True).alias("success"),
             F.count_if(F.col(tie) > F.col("s_max")).alias("tail"))
    )
    return plain.unionByName(between)


def _still_open(anchor: Column, at: Column, within_s: int) -> Column:
    return F.when(at - anchor <= within_s, anchor)


def _next_anchor(anchor: Column, row: Column, within_s: int) -> Column:
    """Start of the open window after a second, given the one before it (null: none open)."""
    at = row["timestamp"]
    opened = F.when(row["head"] > 0, F.coalesce(_still_open(anchor, at, within_s), at)).otherwise(
        _still_open(anchor, at, within_s))
    after_success = F.when(row["tail"] > 0, at)
    return F.when(row["success"], after_success).otherwise(opened)


_PART = "array<struct<anchor: bigint, n: bigint, last: bigint, cancelled: boolean>>"


def _parts(anchor: Column, row: Column, within_s: int) -> Column:
    """What a second adds to windows.  A window opened and cancelled within it adds nothing."""
    at, null = row["timestamp"], F.lit(None).cast("bigint")
    open_now = _still_open(anchor, at, within_s)
    part = lambda *values: F.struct(*(v.alias(n) for v, n in zip(values, ["anchor", "n", "last", "cancelled"])))
    no_parts = F.array().cast(_PART)
    counted = F.when(row["head"] > 0, F.array(part(F.coalesce(open_now, at), row["head"], at, F.lit(False))))
    ended = F.when(open_now.isNotNull(), F.array(
        part(open_now, row["head"], F.when(row["head"] > 0, at).otherwise(null), F.lit(True))))
    begun = F.when(row["tail"] > 0, F.array(part(at, row["tail"], at, F.lit(False))))
    with_success = F.concat(F.coalesce(ended, no_parts), F.coalesce(begun, no_parts))
    return F.when(row["success"], with_success).otherwise(F.coalesce(counted, no_parts))


def login_fail_window(logins: DataFrame, tie: str, max_fail: int = 5, within_s: int = 5,
                      chunk_s: int = CHUNK_S) -> DataFrame:
    """The first failure opens a window of ``within_s`` seconds (end included); a success
    inside cancels it; at its end, ``max_fail`` or more failures give a warning.

    Where a window starts depends on where the one before ended.  Each chunk of a
    user's seconds is therefore evaluated for every state it can be entered in:
    no open window, or one begun 1..within_s seconds before the chunk.  Stringing
    these small tables together per user gives the true entry state, and each
    chunk then fills in its windows on its own.  A chunk has at most ``chunk_s``
    rows whatever the number of logins, and a user one small table per ``chunk_s``
    of the time covered: 52,560 in a year.
    """
    bigint = lambda value: F.lit(value).cast("bigint")
    seconds = _login_seconds(logins, tie).withColumn("_chunk", floor_div("timestamp", chunk_s))
    # both uses of the chunks read this one exchange, also when the input comes split by user
    chunks = seconds.repartition("user_id", "_chunk").groupBy("user_id", "_chunk").agg(
        F.sort_array(F.collect_list(F.struct("timestamp", "head", "success", "tail"))).alias("_rows"))

    # state i: window begun i seconds before the chunk; state 0: none.  A chunk whose first
    # row comes after all such windows have ended leaves in one state only.
    start = F.col("_chunk") * chunk_s
    no_window = F.lit(None).cast("bigint")
    reached = F.get("_rows", F.lit(0))["timestamp"] - start < within_s
    entries = F.when(reached, F.array(no_window, *(start - i for i in range(1, within_s + 1)))).otherwise(
        F.array(no_window))
    exits = F.aggregate("_rows", entries, lambda states, row: F.transform(
        states, lambda anchor: _next_anchor(anchor, row, within_s)))
    per_user = (
        chunks.select("user_id", "_chunk", exits.alias("_exits"))
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_list(F.struct("_chunk", "_exits"))).alias("_tables"))
    )

    def enter(state: Column, table: Column) -> Column:
        begin = table["_chunk"] * chunk_s
        age = begin - state["anchor"]
        carried = age <= within_s
        found = F.when(carried, F.array(F.struct(
            table["_chunk"].alias("_chunk"), state["anchor"].alias("_entry")))).otherwise(
            F.array().cast("array<struct<_chunk: bigint, _entry: bigint>>"))
        slot = F.when(carried & (F.size(table["_exits"]) > 1), age).otherwise(bigint(0)).cast("int")
        return F.struct(F.get(table["_exits"], slot).alias("anchor"),
                        F.concat(state["found"], found).alias("found"))

    none_yet = F.struct(F.lit(None).cast("bigint").alias("anchor"),
                        F.array().cast("array<struct<_chunk: bigint, _entry: bigint>>").alias("found"))
    carried = (
        per_user.select("user_id", F.aggregate("_tables", none_yet, enter)["found"].alias("_found"))
        .select("user_id", F.inline("_found"))
    )

    def fill(state: Column, row: Column) -> Column:
        return F.struct(_next_anchor(state["anchor"], row, within_s).alias("anchor"),
                        F.concat(state["parts"], _parts(state["anchor"], row, within_s)).alias("parts"))

    begin = F.struct(F.col("_entry").alias("anchor"), F.array().cast(_PART).alias("parts"))
    windows = (
        chunks.join(carried, ["user_id", "_chunk"], "left")
        .select("user_id", F.inline(F.aggregate("_rows", begin, fill)["parts"]))
        .groupBy("user_id", "anchor")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("cancelled").alias("cancelled"))
        .where(~F.col("cancelled") & (F.col("n") >= max_fail))
    )
    message = F.concat(F.lit(outcomes.login_window_warning(within_s)), F.col("n").cast("string"), F.lit(" times"))
    return windows.select("user_id", F.col("anchor").alias("first_fail_time"),
                          F.col("last").alias("last_fail_time"), message.alias("warning_msg"))


# --- P2: consecutive failures ------------------------------------------------------------------


def login_fail_consecutive(logins: DataFrame, tie: str, times: int = 3, within_s: int = 5,
                           slice_s: int = 60) -> DataFrame:
    """``times`` failures of a user in a row, first to last less than ``within_s`` seconds.

    Every run of ``times`` failures is a match, so matches overlap.  A slice also
    gets the last seconds before it, enough to see any match that ends in it.
    """
    fail = F.col("login_state").eqNullSafe("fail").cast("int")
    slices = F.sequence(floor_div("timestamp", slice_s), floor_div(F.col("timestamp") + within_s - 1, slice_s))
    rows = logins.select("user_id", "timestamp", F.col(tie).alias("_tie"), fail.alias("_fail"),
                         F.explode(slices).alias("_slice"))
    rows = rows.repartition("user_id", "_slice")  # not by user alone, should the input come that way
    ordered = Window.partitionBy("user_id", "_slice").orderBy("timestamp", "_tie")
    marked = rows.withColumn("first_fail_time", F.lag("timestamp", times - 1).over(ordered)).withColumn(
        "_all_failed", F.min("_fail").over(ordered.rowsBetween(-(times - 1), 0)))
    own = F.col("_slice") == floor_div("timestamp", slice_s)
    close = F.col("timestamp") - F.col("first_fail_time") < within_s
    return marked.where(own & (F.col("_all_failed") == 1) & close).select(
        "user_id", "first_fail_time", F.col("timestamp").alias("last_fail_time"),
        F.lit(outcomes.login_run_warning(times)).alias("warning_msg"))


# --- P3: order payment monitor -----------------------------------------------------------------


def order_pay_monitor(orders: DataFrame, timeout_s: int = 900, slice_s: int = 3600) -> DataFrame:
    """The outcomes of every order, for any number of creates and pays.

    A create waits for the next row of its order: a pay before the deadline is a
    success, one at the deadline is late, another create starts the waiting anew; later
    rows, or none, find it timed out.  A pay that no create waits for has none.  Rows of
    one second go create before pay; pays of one second without a create are one outcome.

    Rows are counted per order and second first.  Each row is also copied to the slices
    of time within reach, so an order with very many rows is worked on by many tasks.
    """
    kind = F.col("event_type")
    seconds = orders.where(kind.isin("create", "pay")).groupBy("order_id", "timestamp").agg(
        F.count_if(kind == "create").alias("creates"), F.count_if(kind == "pay").alias("pays"))
    reach = F.sequence(floor_div(F.col("timestamp") - timeout_s, slice_s), floor_div(F.col("timestamp") + timeout_s, slice_s))
    rows = seconds.withColumn("_slice", F.explode(reach)).repartition("order_id", "_slice")
    along = Window.partitionBy("order_id", "_slice").orderBy("timestamp")
    side = F.struct("timestamp", "creates", "pays")
    seen = rows.withColumn("_before", F.lag(side).over(along)).withColumn("_after", F.lead(side).over(along))
    own = seen.where(F.col("_slice") == floor_div("timestamp", slice_s))

    outcome = lambda state, late: F.struct(F.lit(state).alias("result_state"), F.lit(late).alias("is_timeout_side"))
    wait = F.col("_after.timestamp") - F.col("timestamp")
    of_create = (
        F.when(F.col("creates") == 0, None)
        .when(F.col("pays") > 0, outcome(outcomes.PAID, False))
        .when(wait.isNull() | (wait > timeout_s), outcome(outcomes.TIMEOUT, True))
        .when(F.col("_after.creates") > 0, None)
        .when(wait < timeout_s, outcome(outcomes.PAID, False))
        .otherwise(outcome(outcomes.PAID_LATE, True))
    )
    waiting = (F.col("_before.creates") > 0) & (F.col("_before.pays") == 0) & (
        F.col("timestamp") - F.col("_before.timestamp") <= timeout_s)
    taken = F.when((F.col("creates") > 0) | F.coalesce(waiting, F.lit(False)), 1).otherwise(0)
    of_pay = F.when(F.col("pays") > taken, outcome(outcomes.NO_CREATE, True))
    return own.select("order_id", F.inline(F.array_compact(F.array(of_create, of_pay))))


# --- P4, P5: create followed by pay ------------------------------------------------------------


class OrderPattern(NamedTuple):
    matched: DataFrame
    timed_out: DataFrame


def order_pay_pattern(orders: DataFrame, within_s: int = 300, slice_s: int = 3600) -> OrderPattern:
    """Each create with a later pay less than ``within_s`` seconds away, and the others.

    Rows are counted per order and second first (creates go before pays of the
    same second).  Pays are copied to the slices from which a create can reach them.
    """
    kind = F.col("event_type")
    seconds = orders.where(kind.isin("create", "pay")).groupBy("order_id", "timestamp").agg(
        F.count_if(kind == "create").alias("creates"), F.count_if(kind == "pay").alias("pays"))
    first = F.when(F.col("pays") > 0, floor_div(F.col("timestamp") - (within_s - 1), slice_s)).otherwise(
        floor_div("timestamp", slice_s))
    rows = seconds.withColumn("_slice", F.explode(F.sequence(first, floor_div("timestamp", slice_s))))
    reach = Window.partitionBy("order_id", "_slice").orderBy("timestamp").rangeBetween(0, within_s - 1)
    paid = F.max(F.col("pays") > 0).over(reach)
    own = F.col("_slice") == floor_div("timestamp", slice_s)
    creates = _repeat(rows.withColumn("_paid", paid).where(own & (F.col("creates") > 0)), "creates")
    limit = ((F.col("timestamp") + within_s) * 1000).cast("string")
    return OrderPattern(
        creates.where("_paid").select("order_id", F.lit(outcomes.PAIRED).alias("result_state")),
        creates.where("NOT _paid").select("order_id", F.concat(F.lit(outcomes.TIMEOUT), limit).alias("result_state")),
    )
