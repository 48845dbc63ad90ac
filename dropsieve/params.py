"""Run parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QCParams:
    """Thresholds of the expression side."""

    load_min_features: int = 200
    load_min_cells: int = 3
    min_features: int = 200
    min_counts: int = 500
    max_mito: float = 20.0
    min_nuclear: float = 0.4
    mt_pattern: str = "^MT-"
    rb_pattern: str = "^RP[SL]"
    denoised: bool = False
    multiome: bool = False
    metadata: str | None = None


@dataclass(frozen=True)
class AtacParams:
    """Thresholds and window constants of the chromatin side."""

    min_count: float = 1000
    max_count: float = 100000
    min_features: float = 500
    min_tss: float = 2
    max_nucleosome: float = 4
    max_blacklist: float = 0.05
    peak_min_cells: int = 1
    mono_lo: int = 147
    mono_hi: int = 294
    tss_window: int = 1000
    tss_flank: int = 100
    tss_centre_lo: int = -501
    tss_centre_hi: int = 499


@dataclass(frozen=True)
class EmbedParams:
    """Constants of normalisation, embedding, neighbours and clustering."""

    scale_factor: float = 1e4
    n_variable: int = 2000
    loess_span: float = 0.3
    clip: float = 10.0
    n_components: int = 50
    k: int = 20
    prune: float = 1.0 / 15.0
    resolution: float = 0.2
    seed: int = 1000


# Bands of the called-set difference, in percent.
OK_BAND = 5.0
WARN_BAND = 20.0
