"""The registry of daily technical factors, as series expressions by family.

Base columns: open/high/low/close are back-adjusted; vol, amount and turnover_rate (in percent) are as delivered.
A window's value needs as many rows without null as the window is long; divisions by zero or null give null.
"""

from __future__ import annotations

from dataclasses import dataclass

from kairopanel.functions.series import (
    Series, absolute, avg, coalesce, col, cumulative, ema, first_row, greater_count, greatest, highest, kurtosis, lag, least, ln, lowest,
    mean_deviation, rank_desc, recur, row_number, rows_since_high, rows_since_low, running_max, skewness, skip_avg, std, total, var0, weighted, when,
)

O, H, L, C = (col(f"{x}_hfq") for x in ("open", "high", "low", "close"))  # noqa: E741
VOL, AMOUNT, TURNOVER = col("vol"), col("amount"), col("turnover_rate")
MEAN_SPANS = (3, 5, 10, 20, 30, 55, 60, 120, 250)


@dataclass(frozen=True)
class Factor:
    name: str
    family: str
    series: Series
    registered: bool = True

    @property
    def fields(self) -> list[str]:
        """Columns it reads."""
        found: set[str] = set()

        def visit(e: Series) -> None:
            if e.op == "col":
                found.add(e.args[0])
            for c in e.children:
                visit(c)

        visit(self.series)
        return sorted(found)


REGISTRY: dict[str, Factor] = {}


def _add(family: str, series: dict[str, Series], registered: bool = True) -> None:
    for name, s in series.items():
        if name in REGISTRY:
            raise ValueError(f"factor {name} is there already")
        REGISTRY[name] = Factor(name, family, s, registered)


def register(name: str, family: str, series: Series) -> Factor:
    """Adds a user's factor, of series and kernels; it then runs in the same jobs and SQL views as the built-in ones."""
    _add(family, {name: series}, registered=False)
    return REGISTRY[name]


def families() -> dict[str, list[Factor]]:
    by: dict[str, list[Factor]] = {}
    for f in REGISTRY.values():
        by.setdefault(f.family, []).append(f)
    return by


# --- shared pieces ---

C1 = lag(C, 1)
CHANGE = C - C1
TYPICAL = (H + L + C) / 3
TRUE_RANGE = greatest(H - L, absolute(H - C1), absolute(L - C1))
RETURN = C / C1 - 1


def slope(n: int) -> Series:
    """Least-squares slope of the last n closes against 1..n."""
    k = [i - (n - 1) / 2 for i in range(n)]
    return weighted(C, k) / sum(x * x for x in k)


def mean_of_means(spans: tuple[int, ...], partial: bool) -> Series:
    """The mean of several means; partial: windows that aren't full count as 0."""
    parts = [coalesce(avg(C, n), 0) if partial else avg(C, n) for n in spans]
    return sum(parts[1:], parts[0]) / len(spans)


def wilder(n: int) -> Series:
    up, both = recur(non_null(CHANGE, greatest(CHANGE, 0)), 1.0 / n), recur(absolute(CHANGE), 1.0 / n)
    return when(CHANGE.is_null(), None, when(both.same(0), 100, up / both * 100))


def ratio_100(a: Series, b: Series) -> Series:
    return a / b * 100


def non_null(flag: Series, then: Series) -> Series:
    return when(flag.is_null(), None, then)


# --- price and moving averages ---

_add("average_price", {"average_price_hlc": TYPICAL, "average_price_ohlc": (O + H + L + C) / 4})
_add("simple_moving_average", {f"simple_moving_average_{n}": avg(C, n) for n in (3, 5, 10, 20, 30, 55, 60, 90, 120, 250)})
_add("high_moving_average", {f"high_moving_average_{n}": avg(H, n) for n in MEAN_SPANS})
_add("low_moving_average", {f"low_moving_average_{n}": avg(L, n) for n in MEAN_SPANS})
_add("variation_moving_average", {f"variation_moving_average_{n}": avg((O + H + L + C) / 4, n) for n in MEAN_SPANS})
_add("cost_moving_average", {f"cost_moving_average_{n}": total(VOL * (O + C) / 2, n) / total(VOL, n) for n in MEAN_SPANS})
_add("average_turnover_rate", {f"average_turnover_rate_{n}": avg(TURNOVER, n) for n in (3, 5, 10, 20, 30, 55, 60, 120, 240, 250)})
_add("turnover_rate_ratio", {f"turnover_rate_ratio_{n}_120": avg(TURNOVER, n) / avg(TURNOVER, 120) for n in (5, 10, 20, 60)})
_add("exponential_average", {f"exponential_average_{n}": ema(C, n) for n in (12, 50)})
_add("exponential_moving_average", {f"exponential_moving_average_{n}": ema(C, n) for n in (3, 5, 10, 20, 30, 55, 60, 90, 120, 250)})
_add("double_exponential_moving_average", {f"double_exponential_moving_average_{n}": 2 * ema(C, n) - ema(ema(C, n), n) for n in (10, 20, 60)})

MID6 = (3 * C + L + O + H) / 6
DKX = weighted(MID6, list(range(20, 0, -1))) / 210  # the largest weight falls on the oldest day, as the registry's code has it
_add("dkx_indicator", {"dkx": DKX, "moving_average_dkx_10": avg(DKX, 10)})

BBI, BBI21 = mean_of_means((3, 6, 12, 24), partial=True), mean_of_means((3, 6, 12, 21), partial=False)
_add("bull_and_bear_index", {
    "bull_and_bear_index_3_6_12_21": BBI21,
    "bull_and_bear_index_3_6_12_24": BBI,
    "bull_and_bear_index_bollinger_lower_3_6_12_24_6_11": BBI - 6 * std(BBI, 11),
    "bull_and_bear_index_bollinger_upper_3_6_12_24_6_11": BBI + 6 * std(BBI, 11),
    "bull_and_bear_index_momentum_3_6_12_24": BBI / C,
})
UDL = mean_of_means((3, 5, 10, 20), partial=True)
_add("udl_indicator", {"udl": UDL, "moving_average_udl_6": avg(UDL, 6)})

# --- bands and deviations ---

_add("bollinger_band", {
    "bollinger_lower_band_20_2": avg(C, 20) - 2 * std(C, 20),
    "bollinger_middle_band_20_2": avg(C, 20),
    "bollinger_upper_band_20_2": avg(C, 20) + 2 * std(C, 20),
})
_add("donchian_channel", {
    "donchian_channel_lower_band_20": lowest(L, 20),
    "donchian_channel_middle_band_20": (highest(H, 20) + lowest(L, 20)) / 2,
    "donchian_channel_upper_band_20": highest(H, 20),
})
_add("keltner_channel", {
    "keltner_channel_lower_band_20_10": avg(C, 20) - 2 * avg(TRUE_RANGE, 10),
    "keltner_channel_middle_band_20_10": avg(C, 20),
    "keltner_channel_upper_band_20_10": avg(C, 20) + 2 * avg(TRUE_RANGE, 10),
})
_add("average_true_range", {f"average_true_range_{n}": avg(TRUE_RANGE, n) for n in (6, 14, 20)})
for _name, _n in (("annual", 250), ("quarterly", 60), ("monthly", 20)):
    _add("price_average_deviation", {f"{_name}_price_average_deviation_{_n}": C / avg(C, _n) - 1})
_add("annual_price_rank_position", {"annual_price_rank_position_250": 1 + greater_count(C, 250)})
BIAS36 = avg(C, 3) - avg(C, 6)
_add("bias", {"bias_36": BIAS36, "bias_612": avg(C, 6) - avg(C, 12), "moving_average_bias_36_6": avg(BIAS36, 6)})
_add("bias_ratio", {f"bias_ratio_{n}": (C - avg(C, n)) / avg(C, n) * 100 for n in (6, 12, 24, 60)})
_add("osc_indicator", {"osc_10": 100 * (C - avg(C, 10))})
DFMA = avg(C, 10) - avg(C, 50)
_add("parallel_line_difference", {"parallel_line_difference_10_50": DFMA, "parallel_line_difference_average_10_50_10": avg(DFMA, 10)})
DPO = C - lag(avg(C, 20), 10)
_add("detrended_price_oscillator", {"detrended_price_oscillator_20_10": DPO, "detrended_price_oscillator_average_20_10_6": avg(DPO, 6)})
_add("return_variance", {f"return_variance_{n}": var0(RETURN, n) for n in (20, 60, 120)})


_add("return_skewness", {f"return_skewness_{n}": skewness(RETURN, n) for n in (20, 60, 120)})
_add("return_kurtosis", {f"return_kurtosis_{n}": kurtosis(RETURN, n) for n in (20, 60, 120)})
_add("volume_standard_deviation", {f"volume_standard_deviation_{n}": std(VOL, n) for n in (10, 20)})
_add("turnover_value_standard_deviation", {f"turnover_value_standard_deviation_{n}": std(AMOUNT, n) for n in (6, 20)})

# --- momentum and rates of change ---

_add("acceleration_rate", {"acceleration_rate_8": slope(8) / C})
_add("price_linear_regression_coefficient", {f"price_linear_regression_coefficient_{n}": slope(n) / avg(C, n) for n in (6, 12, 24)})
MTM = C - lag(C, 12)
_add("momentum", {"momentum_12": MTM, "momentum_average_12_6": avg(MTM, 6)})


def roc(n: int) -> Series:
    return (C - lag(C, n)) / lag(C, n) * 100


_add("rate_of_change", {f"rate_of_change_{n}": roc(n) for n in (6, 12, 20, 60, 120)} | {"rate_of_change_average_12_6": avg(roc(12), 6)})
_add("rate_of_change_ratio", {"rate_of_change_percentage_10": (C - lag(C, 10)) / lag(C, 10), "rate_of_change_ratio_10": C / lag(C, 10), "rate_of_change_ratio_100_10": C / lag(C, 10) * 100})
_add("monthly_return_rank_score", {"monthly_return_rank_score_20": rank_desc(C / lag(C, 20) - 1)})
DIF = ema(C, 12) - ema(C, 26)
DEA = ema(DIF, 9)
_add("moving_average_convergence_divergence", {
    "moving_average_convergence_divergence_difference_line_12_26_9": DIF,
    "moving_average_convergence_divergence_histogram_12_26_9": 2 * (DIF - DEA),
    "moving_average_convergence_divergence_signal_line_12_26_9": DEA,
})
_add("percentage_price_oscillator", {"percentage_price_oscillator_12_26": DIF / ema(C, 26) * 100})
_add("absolute_price_oscillator", {"absolute_price_oscillator_12_26": DIF}, registered=False)


def trix(*spans: int) -> Series:
    e = C
    for n in spans:
        e = ema(e, n)
    return (e - lag(e, 1)) / lag(e, 1) * 100


_add("triple_exponential_oscillator", {"triple_exponential_oscillator_5_10_5": trix(5, 10, 5), "triple_exponential_oscillator_12": trix(12, 12, 12), "triple_exponential_oscillator_average_12_20": avg(trix(12, 12, 12), 20)})
_r21 = lag(ln(C / C1), 21)
_add("long_momentum", {"momentum_504_21_126": when(total(when(_r21.is_null(), 0, 1), 504) >= 504, weighted(coalesce(_r21, 0), [0.5 ** ((503 - i) / 126) for i in range(504)]))}, registered=False)
_E2 = ema(ema(H - L, 9), 9)
MASS = total(ema(H - L, 9) / _E2, 25)
_add("mass_index", {"mass_index_9_25": MASS, "mass_index_average_9_25_6": avg(MASS, 6)})
_SWS = recur(ema(C, 12), non_null(total(TURNOVER, 5), greatest(1, total(TURNOVER, 5) / 3)))
_add("fsl_indicator", {"watershed_swl_5_10": (7 * ema(C, 5) + 3 * ema(C, 10)) / 10, "watershed_sws_12_5": _SWS})

# --- oscillators ---

_add("relative_strength_index", {f"relative_strength_index_{n}": wilder(n) for n in (6, 12, 24)})
_add("relative_strength_index_14", {"relative_strength_index_14": wilder(14)}, registered=False)
_add("marsi_indicator", {f"moving_average_relative_strength_index_{n}": avg(wilder(n), n) for n in (6, 10)})
_UP, _DOWN = total(non_null(CHANGE, greatest(CHANGE, 0)), 14), total(non_null(CHANGE, greatest(0 - CHANGE, 0)), 14)
_add("chande_momentum_oscillator", {"chande_momentum_oscillator_14": when((_UP + _DOWN).same(0), 0, 100 * (_UP - _DOWN) / (_UP + _DOWN))})
_add("commodity_channel_index", {f"commodity_channel_index_{n}": (TYPICAL - avg(TYPICAL, n)) / (0.015 * mean_deviation(TYPICAL, n)) for n in (10, 14, 20, 60, 120)})
_RSV = (C - lowest(L, 9)) / (highest(H, 9) - lowest(L, 9)) * 100
_K = recur(_RSV, 1 / 3, 50.0)
_D = recur(_K, 1 / 3, 50.0)
_add("stochastic_oscillator", {"stochastic_k_line_9_3_3": _K, "stochastic_d_line_9_3_3": _D, "stochastic_j_line_9_3_3": 3 * _K - 2 * _D})
_FASTK = (C - lowest(L, 5)) / (highest(H, 5) - lowest(L, 5)) * 100
_add("stochastic_fast", {"stochastic_fast_k_line_5_3": _FASTK, "stochastic_fast_d_line_5_3": skip_avg(_FASTK, 3)})
_RSI14 = wilder(14)
_SRSI = (_RSI14 - lowest(_RSI14, 5)) / (highest(_RSI14, 5) - lowest(_RSI14, 5)) * 100
_add("stochastic_relative_strength_index", {"stochastic_relative_strength_index_fast_k_14_5_3": _SRSI, "stochastic_relative_strength_index_fast_d_14_5_3": skip_avg(_SRSI, 3)})
_LWR1 = recur((highest(H, 9) - C) / (highest(H, 9) - lowest(L, 9)) * 100, 1 / 3, 50.0)
_add("lwr_indicator", {"lwr_1_9_3_3": _LWR1, "lwr_2_9_3_3": recur(_LWR1, 1 / 3, 50.0)})


def williams(n: int) -> Series:
    width = highest(H, n) - lowest(L, n)
    return when(width.same(0), 0, (highest(H, n) - C) / width * 100)


_add("williams_percent_range", {f"williams_percent_range_{n}": williams(n) for n in (6, 10)})
_BP, _TR2 = C - least(L, C1), greatest(H, C1) - least(L, C1)
_add("ultimate_oscillator", {"ultimate_oscillator_7_14_28": 100 * (4 * (total(_BP, 7) / total(_TR2, 7)) + 2 * (total(_BP, 14) / total(_TR2, 14)) + total(_BP, 28) / total(_TR2, 28)) / 7})
_ARON_UP, _ARON_DOWN = (25 - rows_since_high(H, 25)) / 25 * 100, (25 - rows_since_low(L, 25)) / 25 * 100
_add("arron_indicator", {"arron_up_25": _ARON_UP, "arron_down_25": _ARON_DOWN, "arron_oscillator_25": _ARON_UP - _ARON_DOWN})
_PSY = total(when(C > C1, 1, 0), 12) / 12 * 100
_add("psychological_line", {"psychological_line_12": _PSY, "psychological_line_average_12_6": avg(_PSY, 6)})
_add("balance_of_power", {"balance_of_power": when(H.same(L), None, (C - O) / (H - L))})
_add("elder_power", {"bear_power_13": (L - ema(C, 13)) / C, "bull_power_13": (H - ema(C, 13)) / C})

# --- directional movement ---

_UPM, _DNM = H - lag(H, 1), lag(L, 1) - L
_PLUS, _MINUS = when((_UPM > _DNM) & (_UPM > 0), _UPM, 0), when((_DNM > _UPM) & (_DNM > 0), _DNM, 0)
_PDI, _MDI = ratio_100(total(_PLUS, 14), total(TRUE_RANGE, 14)), ratio_100(total(_MINUS, 14), total(TRUE_RANGE, 14))
_DX = absolute(_PDI - _MDI) / (_PDI + _MDI) * 100
_ADX = avg(_DX, 6)
_add("directional_movement_index", {
    "average_directional_index_14_6": _ADX,
    "average_directional_index_rating_14_6": (_ADX + lag(_ADX, 6)) / 2,
    "directional_movement_index_14": _DX,
    "directional_movement_negative_indicator_14": _MDI,
    "directional_movement_positive_indicator_14": _PDI,
    "minus_directional_movement_14": total(_MINUS, 14),
    "plus_directional_movement_14": total(_PLUS, 14),
})
_O1 = lag(O, 1)
_STM = total(when(O <= _O1, 0, greatest(H - O, O - _O1)), 23)
_SBM = total(when(O >= _O1, 0, greatest(O - L, O - _O1)), 23)
_ADTM = when(_STM > _SBM, (_STM - _SBM) / _STM, when(_STM.same(_SBM), 0, (_STM - _SBM) / _SBM))
_add("adtm_indicator", {"adtm_23": _ADTM, "moving_average_adtm_23_8": avg(_ADTM, 8)})
_A, _B, _CC, _DD = absolute(H - C1), absolute(L - C1), absolute(H - lag(L, 1)), absolute(C1 - _O1)
_R = when((_A >= _B) & (_A >= _CC), _A + 0.5 * _B + 0.25 * _DD, when((_B >= _A) & (_B >= _CC), _B + 0.5 * _A + 0.25 * _DD, _CC + 0.25 * _DD))
_SI = 16 * (C - C1 + 0.5 * (C - O) + (C1 - _O1)) / _R * greatest(_A, _B)
_ASI = total(_SI, 26)
_add("accumulation_swing_index", {"accumulation_swing_index_26": _ASI, "accumulation_swing_index_average_26_10": avg(_ASI, 10)})
_AR = ratio_100(total(H - O, 26), total(O - L, 26))
_BR = ratio_100(total(non_null(C1, greatest(H - C1, 0)), 26), total(non_null(C1, greatest(C1 - L, 0)), 26))
_add("popularity_willingness_index", {"ar_br_difference_26": _AR - _BR, "ar_indicator_26": _AR, "br_indicator_26": _BR})
_add("popularity_willingness_unregistered", {"popularity_index_ar_26": _AR, "willingness_index_br_26": _BR, "popularity_willingness_difference_26": _AR - _BR}, registered=False)
_M1 = lag((H + L) / 2, 1)
_add("price_momentum_index", {"price_momentum_index_20": ratio_100(total(non_null(_M1, greatest(H - _M1, 0)), 20), total(non_null(_M1, greatest(_M1 - L, 0)), 20))})


def streak(condition: Series) -> Series:
    """Rows since the condition last failed; null counts as failed."""
    return row_number() - running_max(when(condition, None, row_number()))


_add("consecutive_days", {"consecutive_down_days": streak(C < C1), "consecutive_up_days": streak(C > C1)})

# --- volume and turnover ---

_ADL = cumulative(when(H.same(L), 0, ((C - L) - (H - C)) / (H - L)) * VOL)
_add("accumulation_distribution_line", {"accumulation_distribution_line": _ADL})
_add("chaikin_oscillator", {"chaikin_accumulation_distribution_oscillator_3_10": ema(_ADL, 3) - ema(_ADL, 10)})
_add("on_balance_volume", {"on_balance_volume": cumulative(when(C > C1, VOL, when(C < C1, 0 - VOL, 0)))})
_add("money_flow", {"money_flow_20": total(TYPICAL * VOL, 20)})
_T1 = lag(TYPICAL, 1)
_PMF = total(non_null(_T1, when(TYPICAL > _T1, TYPICAL * VOL, 0)), 14)
_NMF = total(non_null(_T1, when(TYPICAL < _T1, TYPICAL * VOL, 0)), 14)
_add("money_flow_index", {"money_flow_index_14": when(_PMF.is_null() | _NMF.is_null(), None, when(_NMF.same(0), 100, 100 - 100 / (1 + _PMF / _NMF)))})
_AV, _BV, _CV = (total(non_null(C1, when(test, VOL, 0)), 26) for test in (C > C1, C < C1, C.same(C1)))
_add("volume_ratio", {"volume_ratio_26": when((_BV + 0.5 * _CV).same(0), 100, (_AV + 0.5 * _CV) / (_BV + 0.5 * _CV) * 100)})
_add("volume_return_interaction", {"volume_return_interaction_20": VOL / avg(VOL, 20) * avg(RETURN, 20)})
_VPT = (C - C1) / C1 * VOL
_add("single_day_volume_price_trend", {"single_day_volume_price_trend": _VPT, "single_day_volume_price_trend_average_6": avg(_VPT, 6), "single_day_volume_price_trend_average_12": avg(_VPT, 12)})
_WVAD = total(when(H.same(L), None, (C - O) / (H - L) * VOL), 6)
_add("williams_variable_accumulation_distribution", {"williams_variable_accumulation_distribution_6": _WVAD, "williams_variable_accumulation_distribution_average_6_6": avg(_WVAD, 6)})
_HL = H + L
_EMV = avg(100 * (_HL - lag(_HL, 1)) / _HL * (avg(VOL, 14) / VOL) * (H - L) / avg(H - L, 14), 14)
_add("ease_of_movement", {"ease_of_movement_value_14": _EMV, "ease_of_movement_average_14_9": avg(_EMV, 9)})
_add("tapi_indicator", {"tapi": AMOUNT / C, "moving_average_tapi_6": avg(AMOUNT / C, 6)})
_add("market_energy", {"market_energy_21": 100 - 100 / (1 + ema(TURNOVER, 21))})
_add("market_cost", {"market_cost": recur(AMOUNT / VOL, when(TURNOVER.is_null(), None, greatest(0, least(TURNOVER / 100, 1))), carry=True)})

# --- adaptive averages ---

_ER = when(total(absolute(CHANGE), 10).same(0), 0, absolute(C - lag(C, 10)) / total(absolute(CHANGE), 10))
_SC = _ER * (2 / 3 - 2 / 31) + 2 / 31
# seeded with the mean of the first ten closes in a row that end at row 11 or later; then every window of eleven closes moves it
_SEED = when(row_number() < 11, None, avg(C, 10))
_SEED_ROW = first_row(_SEED)
_add("kaufman_adaptive_moving_average", {"kaufman_adaptive_moving_average_10_2_30": recur(when(row_number().same(_SEED_ROW), _SEED, C), when(row_number().same(_SEED_ROW), 1, when(row_number() > _SEED_ROW, _SC * _SC)))})
_XA = (2 * C + H + L) / 4
_XDD = recur(C, absolute(_XA - avg(C, 20)) / avg(C, 20))
_add("xue_si_channel_ii", {
    "xue_si_channel_ii_line_1_102_7": avg(_XA, 5) * 102 / 100,
    "xue_si_channel_ii_line_2_102_7": avg(_XA, 5) * 98 / 100,
    "xue_si_channel_ii_line_3_102_7": 1.07 * _XDD,
    "xue_si_channel_ii_line_4_102_7": 0.93 * _XDD,
})
