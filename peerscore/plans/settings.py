"""Fixed values of the fund instance: labels, rates, units and thresholds."""

from __future__ import annotations

from ..operators.reference import INDEX_LEVEL, PERCENT_PER_DAY, PERCENT_PER_MONTH
from ..operators.score import Eligibility, MetricSpec, ScoringConfig

FIXED_INCOME_PREFIX = "Renda Fixa"
DEFAULT_BENCHMARK = "CDI"

# Declared benchmark -> canonical code (fixed values).
BENCHMARK_CODES = {
    "DI de um dia": "CDI",
    "Taxa Selic": "CDI",
    "Não se aplica": "CDI",
    "OUTROS": "CDI",
    "Ibovespa": "CDI",
    "Índice de Preços ao Consumidor Amplo (IPCA/IBGE)": "IPCA",
    "Índice de preços": "IPCA",
    "Índice Nacional de Preços ao Consumidor (INPC/IBGE)": "INPC",
    "Índice Geral de Preços-Mercado (IGP-M)": "IGP-M",
    "Índice de Mercado Andima todas NTN-B": "IMA-B",
    "Índice de Mercado Andima NTN-B até 5 anos": "IMA-B 5",
    "Índice de Mercado Andima NTN-C até 5 anos": "IMA-B 5",
    "Índice de Mercado Andima NTN-B mais de 5 anos": "IMA-B 5+",
    "Índice de Mercado Andima Geral": "IMA-GERAL",
    "Índice de Mercado Andima todas NTN-C": "IMA-GERAL",
    "Índice de Mercado Andima LFT": "IMA-S",
    "IRF-M": "IRF-M",
    "Taxa de juro prefixada": "IRF-M",
}

# Column of the wide reference table -> (code, unit) (fixed values).
REFERENCE_UNITS = {
    "cdi": ("CDI", PERCENT_PER_DAY),
    "ipca": ("IPCA", PERCENT_PER_MONTH),
    "inpc": ("INPC", PERCENT_PER_MONTH),
    "igpm": ("IGP-M", PERCENT_PER_MONTH),
    "ima_b": ("IMA-B", INDEX_LEVEL),
    "ima_b_5": ("IMA-B 5", INDEX_LEVEL),
    "ima_b_5plus": ("IMA-B 5+", INDEX_LEVEL),
    "ima_geral": ("IMA-GERAL", INDEX_LEVEL),
    "ima_s": ("IMA-S", INDEX_LEVEL),
    "irf_m": ("IRF-M", INDEX_LEVEL),
}

# Sources of the wide reference table, in column order (fixed values).
RATE_SOURCES = {
    "cdi": "bcb_cdi",
    "selic": "bcb_selic",
    "ipca": "bcb_ipca",
    "inpc": "bcb_inpc",
    "igpm": "bcb_igpm",
}
LEVEL_FILE_STEMS = {
    "imab-historico": "ima_b",
    "imab5-historico": "ima_b_5",
    "imab5mais-historico": "ima_b_5plus",
    "imageral-historico": "ima_geral",
    "imas-historico": "ima_s",
    "irfm-historico": "irf_m",
}
REFERENCE_COLUMNS = [*RATE_SOURCES, *LEVEL_FILE_STEMS.values()]
ESSENTIAL_SERIES = ("cdi", "selic", "ipca")

# Tax label -> effective rate; no rate leaves the entity unscored (fixed values).
TAX_RATES = {
    "Isento": 0.00,
    "Longo Prazo": 0.15,
    "Curto Prazo": 0.20,
    "Previdenciário": 0.10,
    "Alíquota de 15%": 0.15,
    "Não Aplicável": None,
    "Outros": None,
    "Indefinido": None,
}

# Investor profile -> audiences it may hold (fixed values).
PROFILES = {
    "Geral": ["Público Geral"],
    "Qualificado": ["Público Geral", "Qualificado"],
    "Profissional": ["Público Geral", "Qualificado", "Profissional"],
}

# Weights, thresholds and top-N of the published score (fixed values).
SCORING = ScoringConfig(
    metrics={
        "information_ratio": MetricSpec("positive", 0.60),
        "sortino_ratio": MetricSpec("positive", 0.25),
        "tax_efficiency": MetricSpec("positive", 0.15),
    },
    eligibility=Eligibility(
        situacao="Em Funcionamento Normal",
        nr_cotst_min=1000,
        existing_time_min_days=252,
        equity_min_brl=50_000_000,
    ),
    top_n=5,
    rates=TAX_RATES,
)

# Look-back of the landing zone (fixed values).
SERIES_LOOKBACK_MONTHS = 360
