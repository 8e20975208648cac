"""The 60 candlestick patterns: +1, -1 or 0 for every row, never null.

A number after a letter means so many rows back. All lags come from one window; the rest are projections.
"""

from __future__ import annotations

from functools import reduce

from kairopanel.functions.series import Series, absolute, greatest, lag, least, when
from kairopanel.operators.factors import C, H, L, O

O1, O2, O3, O4 = (lag(O, k) for k in (1, 2, 3, 4))
H1, H2 = lag(H, 1), lag(H, 2)
L1, L2 = lag(L, 1), lag(L, 2)
C1, C2, C3, C4 = (lag(C, k) for k in (1, 2, 3, 4))

BODY, BODY1, RANGE, RANGE1, RANGE2 = absolute(C - O), absolute(C1 - O1), H - L, H1 - L1, H2 - L2
UPPER, LOWER = H - greatest(O, C), least(O, C) - L
DOJI, DOJI1, DOJI2 = BODY <= RANGE * 0.1, BODY1 <= RANGE1 * 0.1, absolute(C2 - O2) <= RANGE2 * 0.1
UP, UP1, UP2, UP3, UP4 = C > O, C1 > O1, C2 > O2, C3 > O3, C4 > O4
DOWN, DOWN1, DOWN2, DOWN3, DOWN4 = C < O, C1 < O1, C2 < O2, C3 < O3, C4 < O4
#: A null row before isn't known; "max(O1, C1)" needs both.
TOP1, BOTTOM1 = when(C1.is_null(), None, greatest(O1, C1)), when(C1.is_null(), None, least(O1, C1))
INSIDE1 = (greatest(O, C) <= TOP1) & (least(O, C) >= BOTTOM1)


def near(a: Series, b: Series, width: Series) -> Series:
    return absolute(a - b) <= width


def every(*tests: Series) -> Series:
    return reduce(lambda a, b: a & b, tests)


PATTERNS: dict[str, Series] = {}


def _add(name: str, up: tuple = (), down: tuple = ()) -> None:
    """Bullish and bearish tests; the bullish one is looked at first."""
    out = when(every(*down), -1, 0) if down else when(every(*up), 1, 0)
    PATTERNS[name] = when(every(*up), 1, out) if up and down else out


def _both(name: str, *tests: Series) -> None:
    """The body's own direction wherever the tests hold."""
    PATTERNS[name] = when(every(*tests), when(UP, 1, when(DOWN, -1, 0)), 0)


_add("cdl2crows", down=(UP2, O1 > C2, DOWN1, O < O1, O > C1, C < C1, C < C2, C > O2))
_add("cdl3blackcrows", down=(DOWN2, DOWN1, DOWN, O1 < O2, O1 > C2, O < O1, O > C1, C1 < C2, C < C1))
_add("cdl3inside", (DOWN2, O1 > C2, C1 < O2, C1 > C2, UP, C > O2), (UP2, O1 < C2, C1 > O2, C1 < C2, DOWN, C < O2))
_add("cdl3linestrike", (DOWN3, DOWN2, DOWN1, C2 < C3, C1 < C2, UP, O < C1, C > O3), (UP3, UP2, UP1, C2 > C3, C1 > C2, DOWN, O > C1, C < O3))
_add("cdl3starsinsouth", (DOWN2, DOWN1, RANGE1 < RANGE2, L1 > L2, RANGE < RANGE1, L > L1))
_add("cdl3whitesoldiers", (UP2, UP1, UP, O1 > O2, O1 < C2, O > O1, O < C1, C1 > C2, C > C1))
_add("cdlabandonedbaby", (DOWN2, DOJI1, H1 < L2, UP, L > H1), (UP2, DOJI1, L1 > H2, DOWN, H < L1))
_add("cdladvanceblock", down=(UP2, UP1, UP, C1 > C2, C > C1, absolute(C2 - O2) > BODY1, BODY1 > BODY))
_add("cdlbelthold", (UP, near(O, L, RANGE * 0.05)), (DOWN, near(O, H, RANGE * 0.05)))
_add("cdlbreakaway", (DOWN4, DOWN3, DOWN2, DOWN1, UP, C > O3), (UP4, UP3, UP2, UP1, DOWN, C < O3))
_add("cdlclosingmarubozu", (UP, near(C, H, RANGE * 0.03)), (DOWN, near(C, L, RANGE * 0.03)))
_add("cdlconcealbabyswallow", (DOWN3, DOWN2, DOWN1, H1 < O2, DOWN, H > H1, L < L1))
_add("cdlcounterattack", (DOWN1, UP, near(C, C1, BODY1 * 0.1)), (UP1, DOWN, near(C, C1, BODY1 * 0.1)))
_add("cdldarkcloudcover", down=(UP1, O > H1, DOWN, C < (O1 + C1) / 2, C > O1))
_add("cdldoji", (DOJI,))
_add("cdldojistar", (DOWN1, DOJI, H < L1), (UP1, DOJI, L > H1))
_add("cdldragonflydoji", (DOJI, UPPER <= RANGE * 0.05, LOWER >= RANGE * 0.6))
_add("cdlengulfing", (DOWN1, UP, O <= C1, C >= O1), (UP1, DOWN, O >= C1, C <= O1))
_add("cdleveningdojistar", down=(UP2, DOJI1, DOWN, C < (O2 + C2) / 2))
_add("cdleveningstar", down=(UP2, BODY1 <= absolute(C2 - O2) * 0.4, DOWN, C < (O2 + C2) / 2))
_add("cdlgapsidesidewhite", (UP1, UP, L > H1, near(O, O1, RANGE * 0.2)), (DOWN1, DOWN, H < L1, near(O, O1, RANGE * 0.2)))
_add("cdlgravestonedoji", down=(DOJI, LOWER <= RANGE * 0.05, UPPER >= RANGE * 0.6))
_HAMMER, _INVERTED = (LOWER >= BODY * 2, UPPER <= BODY * 0.5), (UPPER >= BODY * 2, LOWER <= BODY * 0.5)
_add("cdlhammer", _HAMMER)
_add("cdlhangingman", down=(*_HAMMER, C1 < C))
_add("cdlharami", (DOWN1, UP, INSIDE1), (UP1, DOWN, INSIDE1))
_add("cdlharamicross", (DOWN1, DOJI, INSIDE1), (UP1, DOJI, INSIDE1))
_add("cdlhighwave", (UPPER >= BODY * 2, LOWER >= BODY * 2))
_add("cdlhikkake", (H1 < H2, L1 > L2, H < H1, L < L1), (H1 < H2, L1 > L2, H > H1, L > L1))
_add("cdlhikkakemod", (H1 < H2, L1 > L2, DOWN1, H > H1, C > H1), (H1 < H2, L1 > L2, UP1, L < L1, C < L1))
_add("cdlhomingpigeon", (DOWN1, DOWN, INSIDE1))
_add("cdlidentical3crows", down=(DOWN2, DOWN1, DOWN, near(O1, C2, absolute(O2 - C2) * 0.2), near(O, C1, BODY1 * 0.2), C1 < C2, C < C1))
_add("cdlinneck", down=(DOWN1, UP, O < C1, near(C, C1, absolute(C1) * 0.01)))
_add("cdlinvertedhammer", (*_INVERTED, C1 > C))
_KICK_UP = (DOWN1, near(H1, O1, RANGE1 * 0.05), near(C1, L1, RANGE1 * 0.05), UP, near(H, C, RANGE * 0.05), near(O, L, RANGE * 0.05), O > H1)
_KICK_DOWN = (UP1, near(H1, C1, RANGE1 * 0.05), near(O1, L1, RANGE1 * 0.05), DOWN, near(H, O, RANGE * 0.05), near(C, L, RANGE * 0.05), O < L1)
_add("cdlkicking", _KICK_UP, _KICK_DOWN)
_add("cdlkickingbylength", (*_KICK_UP, RANGE > RANGE1), (*_KICK_DOWN, RANGE > RANGE1))
_add("cdlladderbottom", (DOWN4, DOWN3, DOWN2, L > L1, DOWN1, UP, C > H1))
_add("cdllongleggeddoji", (DOJI, UPPER >= RANGE * 0.35, LOWER >= RANGE * 0.35))
_both("cdllongline", BODY >= RANGE * 0.7)
_add("cdlmarubozu", (UP, near(H, C, RANGE * 0.05), near(O, L, RANGE * 0.05)), (DOWN, near(H, O, RANGE * 0.05), near(C, L, RANGE * 0.05)))
_add("cdlmatchinglow", (DOWN1, DOWN, near(C, C1, absolute(C1) * 0.01)))
_add("cdlmathold", (UP4, C3 < C4, C2 < C4, C1 < C4, C > C4))
_add("cdlmorningdojistar", (DOWN2, DOJI1, UP, C > (O2 + C2) / 2))
_add("cdlmorningstar", (DOWN2, BODY1 <= absolute(C2 - O2) * 0.5, UP, C > (O2 + C2) / 2))
_add("cdlonneck", down=(DOWN1, UP, O < C1, C > C1, near(C, O1, absolute(O1) * 0.01)))
_add("cdlpiercing", (DOWN1, UP, O < C1, C > (O1 + C1) / 2, C < O1))
_add("cdlrickshawman", (DOJI, UPPER >= RANGE * 0.3, LOWER >= RANGE * 0.3))
_LONG4 = BODY >= absolute(C4 - O4) * 0.6
_add(
    "cdlrisefall3methods",
    (UP4, DOWN3, DOWN2, DOWN1, greatest(O3, C3) < C4, greatest(O2, C2) < C4, greatest(O1, C1) < C4, UP, C > C4, _LONG4),
    (DOWN4, UP3, UP2, UP1, least(O3, C3) > C4, least(O2, C2) > C4, least(O1, C1) > C4, DOWN, C < C4, _LONG4),
)
_add("cdlseparatinglines", (DOWN1, UP, near(O, O1, absolute(O1) * 0.01)), (UP1, DOWN, near(O, O1, absolute(O1) * 0.01)))
_add("cdlshootingstar", down=(*_INVERTED, C1 < C))
_both("cdlshortline", BODY <= RANGE * 0.25)
_both("cdlspinningtop", BODY <= RANGE * 0.3, UPPER >= BODY, LOWER >= BODY)
_add("cdlstalledpattern", down=(UP2, UP1, UP, C1 > C2, C > C1, BODY <= BODY1 * 0.6))
_add("cdlsticksandwich", (DOWN2, UP1, DOWN, near(C, C2, absolute(C2) * 0.01)))
_add("cdltakuri", (BODY <= RANGE * 0.08, UPPER <= RANGE * 0.1, LOWER >= RANGE * 0.6))
_add("cdltasukigap", (UP1, DOWN, L > H1, C < C1, C > H1), (DOWN1, UP, H < L1, C > C1, C < L1))
_add("cdlthrusting", down=(DOWN1, UP, O < C1, C > C1, C < (O1 + C1) / 2))
_add("cdltristar", (DOJI2, DOJI1, DOJI, H1 < L2, H < L1), (DOJI2, DOJI1, DOJI, L1 > H2, L > H1))
_add("cdlunique3river", (DOWN2, DOWN1, L1 < L, UP, C < C1))
_add("cdlupsidegap2crows", down=(UP2, DOWN1, L1 > H2, DOWN, O > O1, C > C2))
_add("cdlxsidegap3methods", (UP2, UP1, L1 > H2, DOWN, C < H2, C > C2), (DOWN2, DOWN1, H1 < L2, UP, C > L2, C < C2))


def signals() -> dict[str, Series]:
    return PATTERNS
