"""Order rules: required fields, stock, bursts, and the profiles that combine them.

Rules on single rows are SQL expressions over column names. Burst rules read ``seq``
(arrival order, any orderable type, unique per row) and a time column. A burst rule asks
whether more than ``limit`` rows of a key lie within ``seconds`` up to and including the
row. In (time, seq) order that is the same as asking whether the row ``limit`` places
earlier still lies inside, so a bounded look back is enough and a heavy key can be cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.normalize import held_status, is_filled
from holdfast.functions.times import micros, span
from holdfast.plans.folds import AnchoredWindow, ArrivalBurst, fold_in_key
from holdfast.plans.segments import DEFAULT_SPLIT, Split, lag_in_key
from holdfast.vocabulary import BAD_ADDRESS_KEYWORDS, FRAUD_PRODUCT, FRAUD_USER, FUL_INV, FUL_VALID, HOLD, SYSTEM_HOLD, quoted

EVENT_TIME = "event_time"
ARRIVAL = "arrival"
MIN_ADDRESS = 5


@dataclass(frozen=True)
class Burst:
    """More than ``limit`` rows of a key within ``seconds``."""

    seconds: float
    limit: int


# The burst limits of each profile.
USER_BURST = Burst(10.0, 5)
PRODUCT_BURST = Burst(1.0, 5)
PAID_PRODUCT_BURST = Burst(1.0, 3)
ANCHORED_BURST = Burst(10.0, 5)

# How a profile asks for a burst: (rows, keys, burst, name of the flag, rows that count, time) to rows with the flag.
Flagger = Callable[[DataFrame, Sequence[str], Burst, str, str, str], DataFrame]


def _text(name: str) -> str:
    return f"coalesce(CAST({name} AS string), '')"


def rule_required(user_id: str = "user_id", product_id: str = "product_id", address: str = "shipping_address") -> str:
    """FUL-VALID when user or product is blank or the address is shorter than 5."""
    blank = f"trim({_text(user_id)}) = '' OR trim({_text(product_id)}) = ''"
    return f"CASE WHEN {blank} OR length(trim({_text(address)})) < {MIN_ADDRESS} THEN '{FUL_VALID}' END"


def rule_bad_address(user_id: str = "user_id", address: str = "shipping_address", keywords: Sequence[str] = BAD_ADDRESS_KEYWORDS) -> str:
    """FUL-VALID when the user is empty, or the address is short or holds a bad keyword."""
    text = _text(address)
    tests = [f"{_text(user_id)} = ''", f"length({text}) < {MIN_ADDRESS}", *[f"contains({text}, {quoted([w])})" for w in keywords]]
    return f"CASE WHEN {' OR '.join(tests)} THEN '{FUL_VALID}' END"


def with_stock(df: DataFrame, products: DataFrame) -> DataFrame:
    """Adds ``_known`` and ``_stock`` from the product list (one row per product).

    No broadcast hint: the planner and AQE broadcast the list only when it is small, and
    split a hot product's partition otherwise.
    """
    listed = products.select(F.col("product_id").alias("_product_id"), F.col("stock").alias("_stock"))
    joined = df.join(listed, F.col("product_id") == F.col("_product_id"), "left")
    return joined.select(*df.columns, F.col("_product_id").isNotNull().alias("_known"), "_stock")


def rule_stock_cascade(known: str = "_known", stock: str = "_stock") -> str:
    """FUL-VALID for an unknown product, FUL-INV when nothing is left."""
    return f"CASE WHEN NOT {known} THEN '{FUL_VALID}' WHEN {stock} <= 0 THEN '{FUL_INV}' END"


def _is_paid(status: str = "current_status", product_id: str = "product_id") -> str:
    return f"({status} = 'PAID' AND {is_filled(product_id)})"


def rule_stock_paid(threshold: int = 0, known: str = "_known", stock: str = "_stock") -> str:
    """FUL-INV for a PAID row whose product is unknown or at most at the threshold."""
    return f"CASE WHEN {_is_paid()} AND (NOT {known} OR {stock} <= {threshold}) THEN '{FUL_INV}' END"


def burst_flag(
    df: DataFrame,
    keys: Sequence[str],
    burst: Burst,
    out: str,
    where: str | None = None,
    time: str = "created_at",
    mode: str = EVENT_TIME,
    source: DataFrame | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Adds a boolean: does the row make its key exceed the burst limit?

    ``event_time`` counts rows by time, ties in arrival order. ``arrival`` replays the
    rows in arrival order, where a late row has already been evicted by newer ones.
    """
    if mode == ARRIVAL:
        fold = ArrivalBurst(round(burst.seconds * 1e6), burst.limit)
        return fold_in_key(df, keys, ["seq"], micros(df, time), fold, out, where, source, split)
    looked = lag_in_key(df, keys, [time, "seq"], time, burst.limit, "_back", where, source, split)
    return looked.selectExpr(*df.columns, f"coalesce(_back >= {time} - {span(burst.seconds)}, false) AS {out}")


def rule_anchored_burst(
    df: DataFrame,
    burst: Burst = ANCHORED_BURST,
    out: str = "burst",
    where: str | None = None,
    time: str = "created_at",
    source: DataFrame | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Per (user, product): rows beyond the limit in a window anchored at its first row."""
    fold = AnchoredWindow(round(burst.seconds * 1e6), burst.limit)
    return fold_in_key(df, ["user_id", "product_id"], [time, "seq"], micros(df, time), fold, out, where, source, split)


def classify_cascade(
    df: DataFrame,
    products: DataFrame,
    user_burst: Burst = USER_BURST,
    product_burst: Burst = PRODUCT_BURST,
    time: str = "created_at",
    mode: str = EVENT_TIME,
    split: Split = DEFAULT_SPLIT,
    flag: Flagger | None = None,
) -> DataFrame:
    """Adds ``reason``: required fields, stock, user burst, product burst; first hit wins.

    The user count sees only rows that passed the field and stock rules, the product
    count only rows that also passed the user rule. User and product are compared, looked
    up and counted without the blanks around them; the columns keep them. ``flag`` counts
    in place of the batch rules.
    """
    cols = df.columns
    raw = {c: f"_raw_{c}" for c in ("user_id", "product_id")}
    bare = [f"trim({c}) AS {c}" if c in raw else c for c in cols]
    df = df.selectExpr(*bare, *[f"{c} AS {kept}" for c, kept in raw.items()])
    cols, shown = df.columns, [f"{raw[c]} AS {c}" if c in raw else c for c in cols]
    step = with_stock(df, products).selectExpr(*cols, f"coalesce({rule_required()}, {rule_stock_cascade()}) AS _static")
    flag = flag or (lambda *asked: burst_flag(*asked, mode, df, split))
    step = flag(step, ["user_id"], user_burst, "_user", "_static IS NULL", time)
    step = flag(step, ["product_id"], product_burst, "_product", "(_static IS NULL AND NOT _user)", time)
    bursts = f"CASE WHEN _user THEN '{FRAUD_USER}' WHEN _product THEN '{FRAUD_PRODUCT}' END"
    return step.selectExpr(*shown, f"coalesce(_static, {bursts}) AS reason")


def classify_paid(
    df: DataFrame,
    products: DataFrame,
    burst: Burst = PAID_PRODUCT_BURST,
    threshold: int = 0,
    time: str = "occurred_at",
    mode: str = EVENT_TIME,
    split: Split = DEFAULT_SPLIT,
    flag: Flagger | None = None,
) -> DataFrame:
    """Adds ``reason`` to PAID rows: stock beats burst; every PAID row counts for the burst."""
    cols = df.columns
    step = with_stock(df, products).selectExpr(*cols, f"{rule_stock_paid(threshold)} AS _out")
    flag = flag or (lambda *asked: burst_flag(*asked, mode, df.where(_is_paid()), split))
    step = flag(step, ["product_id"], burst, "_burst", _is_paid(), time)
    return step.selectExpr(*cols, f"coalesce(_out, CASE WHEN _burst THEN '{FRAUD_PRODUCT}' END) AS reason")


def classify_anchored(
    df: DataFrame,
    burst: Burst = ANCHORED_BURST,
    keywords: Sequence[str] = BAD_ADDRESS_KEYWORDS,
    time: str = "created_at",
    split: Split = DEFAULT_SPLIT,
    flag: Flagger | None = None,
) -> DataFrame:
    """Adds ``reason``: bad user or address, else the anchored burst over the other rows."""
    cols = df.columns
    step = df.selectExpr("*", f"{rule_bad_address(keywords=keywords)} AS _static")
    if flag:
        step = flag(step, ["user_id", "product_id"], burst, "_burst", "_static IS NULL", time)
    else:
        step = rule_anchored_burst(step, burst, "_burst", "_static IS NULL", time, df, split)
    return step.selectExpr(*cols, f"coalesce(_static, CASE WHEN _burst THEN '{FRAUD_USER}' END) AS reason")


def hold_decision(df: DataFrame, profile: str) -> DataFrame:
    """Sets ``current_status`` and ``hold_reason`` from ``reason``; the stage is kept.

    In the anchored profile a stage of HOLD also holds the order.
    """
    reason = "reason"
    if profile == "anchored":
        reason = f"coalesce(reason, CASE WHEN current_stage = '{HOLD}' THEN '{SYSTEM_HOLD}' END)"
    kept = [c for c in df.columns if c != "current_status"]
    return df.selectExpr(*kept, f"{reason} AS hold_reason", f"{held_status(reason, 'current_status')} AS current_status")
