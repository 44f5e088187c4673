"""Indicator definitions walked one bar at a time in plain Python (test cross-check only)."""

import math
import statistics

import pandas as pd

NAN = math.nan


def tail(values, i, n):
    """The last n values up to bar i, or None while there are fewer or one is missing."""
    part = values[max(0, i - n + 1): i + 1]
    return part if len(part) == n and not any(math.isnan(v) for v in part) else None


def indicators(close: pd.Series, daily: bool = True) -> pd.DataFrame:
    prices = [float(v) for v in close]
    raw = [NAN] + [b / a - 1 for a, b in zip(prices, prices[1:])]
    filled = [0.0] + raw[1:]
    rows = []
    ema20 = fast = slow = prices[0]
    signal, gain, loss = 0.0, None, None
    for i, p in enumerate(prices):
        if i:
            ema20 += 2 / 21 * (p - ema20)
            fast += 2 / 13 * (p - fast)
            slow += 2 / 27 * (p - slow)
            signal += 2 / 10 * ((fast - slow) - signal)
            up, down = max(p - prices[i - 1], 0.0), max(prices[i - 1] - p, 0.0)
            gain = up if gain is None else gain + (up - gain) / 14
            loss = down if loss is None else loss + (down - loss) / 14
        rsi = 50.0
        if len(prices) < 14:
            rsi = NAN
        elif i >= 14 and loss != 0:
            rsi = 100 - 100 / (1 + gain / loss)
        spread = tail(raw, i, 20) if daily else tail(filled, i, 5)
        volatility = statistics.stdev(spread) if spread else (NAN if daily else 0.0)
        last20, last50 = tail(prices, i, 20), tail(prices, i, 50)
        mid = statistics.fmean(last20) if last20 else NAN
        dev = statistics.stdev(last20) if last20 else NAN
        rows.append({
            "close": p, "volatility": volatility, "daily_return": filled[i], "sma_20": mid,
            "sma_50": statistics.fmean(last50) if last50 else NAN, "ema_20": ema20, "rsi_14": rsi,
            "macd_line": fast - slow, "macd_signal": signal, "macd_hist": fast - slow - signal,
            "bb_upper": mid + 2 * dev, "bb_middle": mid, "bb_lower": mid - 2 * dev,
            "bb_bandwidth": 4 * dev / mid if mid else NAN})
    return pd.DataFrame(rows)
