"""Label expressions: consumption class, skew class, drift status."""

from pyspark.sql import Column, functions as F

from wattloom.schemas import (PSI_MODERATE, PSI_SIGNIFICANT, POWER_CLASSES, TOP_CLASS,
                              UNKNOWN_CLASS)


def power_class(kw: Column) -> Column:
    label = F.when(kw.isNull() | F.isnan(kw), UNKNOWN_CLASS)
    for upper, name in POWER_CLASSES:
        label = label.when(kw < upper, name)
    return label.otherwise(TOP_CLASS)


def skew_class(ratio: Column) -> Column:
    return F.when(ratio < 3, "LOW").when(ratio < 10, "MODERATE").otherwise("HIGH")


def psi_class(psi: Column) -> Column:
    return (F.when(psi < PSI_MODERATE, "none")
            .when(psi < PSI_SIGNIFICANT, "moderate")
            .otherwise("significant"))
