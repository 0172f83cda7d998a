"""Threshold labels. The label texts are data values users filter on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Label texts.
NO_DATA = "Sin datos"
TOO_FEW = "Insuficiente"
EFFICIENCY_LABELS = ("Alta eficiencia", "Eficiencia media", "Baja eficiencia")
INTENSITY_LABELS = ("Gestión intensa", "Gestión moderada", "Gestión escasa")
TREND_LABELS = ("Decreciente", "Estable", "Creciente")
STABILITY_LABELS = ("Consistente", "Volatil")
PROFILE_LABELS = ("Top", "Positiva", "Mixta", "En riesgo")
BAND_LABELS = ("Élite", "Buen desempeño", "Desempeño medio", "Bajo desempeño", "Crítico")

# Thresholds.
EFFICIENCY_HIGH = 0.6
EFFICIENCY_MEDIUM = EFFICIENCY_HIGH * 0.5
SHARE_HIGH = 0.7
SHARE_MEDIUM = 0.4
BAND_FLOORS = (80, 60, 40, 20)
FEWEST_PERIODS = 2


def descending_bands(value: Column, floors: tuple, labels: tuple) -> Column:
    """Label of the first floor that ``value`` reaches; the last label otherwise."""
    chain = F.when(value >= floors[0], labels[0])
    for floor, label in zip(floors[1:], labels[1:]):
        chain = chain.when(value >= floor, label)
    return chain.otherwise(labels[-1])


def efficiency_label(value: Column) -> Column:
    """Efficiency class; NULL gets its own label."""
    bands = descending_bands(value, (EFFICIENCY_HIGH, EFFICIENCY_MEDIUM), EFFICIENCY_LABELS)
    return F.when(value.isNull(), NO_DATA).otherwise(bands)


def share_label(value: Column) -> Column:
    """Class of a share; NULL falls into the lowest class."""
    return descending_bands(value, (SHARE_HIGH, SHARE_MEDIUM), INTENSITY_LABELS)


def tercile_label(value: Column, low: Column, high: Column) -> Column:
    """Position of a slope against the lower and upper cut point."""
    falling, steady, rising = TREND_LABELS
    return F.when(value.isNull(), NO_DATA).when(value < low, falling).when(value < high, steady).otherwise(rising)


def with_enough_periods(n_periods: Column, label: Column) -> Column:
    """Replace the label where the series is too short."""
    return F.when(n_periods < FEWEST_PERIODS, TOO_FEW).otherwise(label)


def stability_label(deviation: Column, median: Column) -> Column:
    """Consistent up to the median deviation, volatile above it."""
    return F.when(deviation.isNull(), NO_DATA).when(deviation <= median, STABILITY_LABELS[0]).otherwise(STABILITY_LABELS[1])


def trend_profile_label(score: Column) -> Column:
    """Profile of a 0..3 trend score."""
    return descending_bands(score, (3, 2, 1), PROFILE_LABELS)


def score_band_label(score: Column) -> Column:
    """Band of a 0..100 score."""
    return descending_bands(score, BAND_FLOORS, BAND_LABELS)
