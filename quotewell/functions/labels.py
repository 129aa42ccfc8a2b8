"""Ordered CASE labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values
RISING, RESILIENT, HIT = "Alta na crise", "Resiliente", "Impactada"
BELOW_MINIMUM = "*** ABAIXO DO MINIMO — verificar carga do CSV de cotacoes ***"


def volume_status(rows: Column, minimum: int = 200_000, message: str = BELOW_MINIMUM) -> Column:
    """OK from `minimum` rows on, else `message`."""
    return F.when(rows >= minimum, "OK").otherwise(F.lit(message))


def resilience_class(base: Column, crisis: Column, kept: str = "0.8") -> Column:
    """First match wins: not negative in the crisis; better than `kept` of the base return; otherwise hit.

    `kept` is a decimal literal, so that decimal returns on the boundary compare exactly.
    """
    return (
        F.when(crisis >= 0, RISING)
        .when(crisis > base * F.lit(kept).cast("decimal(3,2)"), RESILIENT)
        .otherwise(HIT)
    )
