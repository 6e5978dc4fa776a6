"""The reference relation of states: code, full name and macro-region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 27 federative units of Brazil by macro-region.
STATES = (
    ("AC", "Acre", "Norte"),
    ("AP", "Amapá", "Norte"),
    ("AM", "Amazonas", "Norte"),
    ("PA", "Pará", "Norte"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("TO", "Tocantins", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("PB", "Paraíba", "Nordeste"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("SE", "Sergipe", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("SP", "São Paulo", "Sudeste"),
    ("PR", "Paraná", "Sul"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("SC", "Santa Catarina", "Sul"),
)


def ref_br_state(spark: SparkSession) -> DataFrame:
    """The states as an inline table.

    Inline, the optimizer knows its exact size and joins it by broadcast, so a state with
    a third of all orders is never shuffled to one task.
    """
    return inline_states(spark, STATES)


def inline_states(spark: SparkSession, states: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """States given as (code, name, region), as an inline table."""
    rows = ", ".join(str(state) for state in states)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS states (code, name, region)")
