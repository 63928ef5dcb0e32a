"""Wide observations to one row per measured wavelength."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfact.functions import clip_lower, col, particle_type, sensitive_aerosol, spectral_band, wavelength_nm
from skyfact.schemas import ANGSTROM, aod_columns

# Display labels of the measures.
LABELS = {
    "AOD_Value": "AOD",
    "Angstrom_Exponent": "Exponente de Ångström (α)",
    "temperature_mean": "Temp. media (°C)",
    "humidity_mean": "Humedad media (%)",
    "radiation_sum": "Radiación acumulada",
}


def classify_particles(wide: DataFrame) -> DataFrame:
    """Add ``Particle_type``; null throughout when the source has no Angstrom exponent."""
    kind = particle_type(col(ANGSTROM)) if ANGSTROM in wide.columns else F.lit(None).cast("string")
    return wide.withColumn("Particle_type", kind)


def wide_to_long(wide: DataFrame, ids: list[str], aod_cols: list[str]) -> DataFrame:
    """One row per (row, AOD column), empty cells included."""
    values = [col(c).cast("double").alias(c) for c in aod_cols]
    frame = wide.select(*[col(c) for c in ids], *values)
    return frame.unpivot([col(c) for c in ids], [col(c) for c in aod_cols], "AOD_band", "AOD_Value")


def drop_null_measures(long: DataFrame, cols: tuple[str, ...] = ("AOD_Value", "Wavelength_nm")) -> DataFrame:
    for c in cols:
        long = long.filter(col(c).isNotNull())
    return long


def _cell(name: str, numbers: dict[float, int] | None) -> Column:
    """A band's value with all that follows from the band's name; the optimizer folds the latter into constants."""
    nm = wavelength_nm(F.lit(name))
    fields = {
        "AOD_band": F.lit(name), "AOD_Value": clip_lower(col(name).cast("double")), "Wavelength_nm": nm,
        "Spectral_Band": spectral_band(nm), "Sensitive_Aerosol": sensitive_aerosol(nm),
    }
    if numbers is not None:
        found = numbers.get(float(name.removeprefix("AOD_").removesuffix("nm")))
        fields = {"id_wavelength": F.lit(found).cast("int"), "AOD_Value": fields["AOD_Value"]}
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def long_observations(wide: DataFrame, ids: list[str] | None = None, numbers: dict[float, int] | None = None) -> DataFrame:
    """Unpivot, classify and clip: the measured values that become facts.

    The particle class is computed once per wide row, and wavelength, spectral band and sensitivity are
    constants of their column; a row of the result costs no more than its value.  With ``numbers``
    (wavelength to key) the rows have ``id_wavelength`` instead of what describes the band.
    """
    aod = aod_columns(wide.columns)
    if not aod:
        raise ValueError("no AOD columns in the frame")
    if "Particle_type" not in wide.columns:
        wide = classify_particles(wide)
    keep = [c for c in wide.columns if c not in aod] if ids is None else ids
    long = wide.select(*[col(c) for c in keep], F.inline(F.array(*[_cell(c, numbers) for c in aod])))
    return drop_null_measures(long, ("AOD_Value",))


def metrics_long(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Several measures of a row below each other, as (metric, value)."""
    frame = df.select(*[col(c) for c in ids], *[col(m).cast("double").alias(m) for m in metrics])
    return frame.unpivot([col(c) for c in ids], [col(m) for m in metrics], "metric", "value")


def with_labels(long: DataFrame, labels: dict[str, str] | None = None, metric: str = "metric") -> DataFrame:
    """Add the display label of each metric; unknown metrics keep their name."""
    label: Column = col(metric)
    for name, text in {**LABELS, **(labels or {})}.items():
        label = F.when(col(metric) == name, text).otherwise(label)
    return long.withColumn("label", label)
