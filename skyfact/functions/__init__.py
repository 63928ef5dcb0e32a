"""Column expressions; all of them stay inside whole-stage code generation."""

from skyfact.functions.columns import (
    clip_lower,
    col,
    coord_key,
    finite,
    is_enriched,
    known,
    particle_type,
    sensitive_aerosol,
    spectral_band,
    wavelength_nm,
)

__all__ = [
    "clip_lower",
    "col",
    "coord_key",
    "finite",
    "is_enriched",
    "known",
    "particle_type",
    "sensitive_aerosol",
    "spectral_band",
    "wavelength_nm",
]
