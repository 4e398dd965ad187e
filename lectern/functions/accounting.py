"""Token and price arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern import schemas as S
from lectern.functions import text as tx


def estimate_tokens(text: Column) -> Column:
    """About four characters per token; blank text is free."""
    size = F.length(tx.strip(text))
    return F.when(size == 0, F.lit(0)).otherwise(F.ceil(size / 4)).cast("bigint")


def output_ratio(stage: Column) -> Column:
    ratio = F.lit(float(S.DEFAULT_OUTPUT_RATIO))
    for name, value in S.STAGE_OUTPUT_RATIO.items():
        ratio = F.when(stage == name, F.lit(float(value))).otherwise(ratio)
    return ratio


def estimate_output(in_tok: Column, stage: Column) -> Column:
    scaled = F.greatest(F.lit(1).cast("bigint"), F.ceil(in_tok * output_ratio(stage)))
    return F.when(in_tok == 0, F.lit(0)).otherwise(scaled).cast("bigint")


def model_price(
    model: Column,
    side: str,
    prices=S.MODEL_PRICES,
    default_in: float = S.DEFAULT_PRICE_IN,
    default_out: float = S.DEFAULT_PRICE_OUT,
) -> Column:
    """USD per million tokens; the first listed prefix that matches wins."""
    lowered = F.lower(model)
    price = F.lit(str(default_in if side == "in" else default_out)).cast("decimal(18,6)")
    for prefix, price_in, price_out in reversed(list(prices)):
        value = F.lit(str(price_in if side == "in" else price_out)).cast("decimal(18,6)")
        price = F.when(lowered.startswith(prefix), value).otherwise(price)
    return price


def call_cost(in_tok: Column, out_tok: Column, price_in: Column, price_out: Column, provider: Column) -> Column:
    """Exact decimal cost; only the paid provider costs anything."""
    # Tokens x price first, one exact division by a million last.
    total = in_tok.cast("decimal(19,0)") * price_in + out_tok.cast("decimal(19,0)") * price_out
    micro = F.lit("0.000001").cast("decimal(7,6)")
    cost = (total.cast("decimal(28,6)") * micro).cast("decimal(30,12)")
    return F.when(provider == S.PAID_PROVIDER, cost).otherwise(F.lit(0).cast("decimal(30,12)"))
