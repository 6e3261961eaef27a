"""Validation of generated JSON answers, entirely with VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postgauge.config import NEGATIVE_LABEL, POSITIVE_LABEL
from postgauge.functions.text import strip

# Error texts stored with a rejected answer.
NOT_JSON = "La respuesta del LLM no es JSON válido."
NOT_OBJECT = "La respuesta del LLM debe ser un objeto JSON."
BAD_SCHEMA = "La respuesta del LLM no cumple el esquema esperado."

# Limits of the explanation fields.
EVIDENCE_ITEMS = 5
EVIDENCE_CHARS = 240
JUSTIFICATION_CHARS = 500

NUMBER_PATTERN = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"


def _type_at(document: Column, path: str) -> Column:
    """Kind of the JSON value at a path; null when the key is absent."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def _score(document: Column) -> Column:
    """Numbers, booleans and numeric strings as a double; null for the rest."""
    kind = _type_at(document, "$.score")
    text = strip(F.try_variant_get(document, "$.score", "string"))
    number = F.when(text.rlike(NUMBER_PATTERN), F.replace(text, F.lit("_"), F.lit("")))
    return (
        F.when(kind == "STRING", number.try_cast("double"))
        .when(kind == "BOOLEAN", F.try_variant_get(document, "$.score", "boolean").cast("double"))
        .when(
            (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"),
            F.try_variant_get(document, "$.score", "double"),
        )
    )


def answer_document(raw: Column) -> Column:
    """The answer as VARIANT; null when it is not JSON."""
    return F.try_parse_json(F.coalesce(raw, F.lit("")))


def parsed_answer(document: Column) -> Column:
    """Struct of label, score, evidence, justification and error.

    Exactly one of ``label`` and ``error`` is set.
    """
    kind = F.schema_of_variant(document)

    label = F.lower(strip(F.try_variant_get(document, "$.label", "string")))
    label_ok = (_type_at(document, "$.label") == "STRING") & label.isin(
        POSITIVE_LABEL, NEGATIVE_LABEL
    )
    score = _score(document)
    score_ok = score.between(0.0, 1.0) & ~F.isnan(score)

    evidence_kind = _type_at(document, "$.evidence")
    items = F.try_variant_get(document, "$.evidence", "array<variant>")
    evidence_ok = evidence_kind.isNull() | (
        evidence_kind.startswith("ARRAY")
        & F.forall(items, lambda item: F.coalesce(F.schema_of_variant(item), F.lit("VOID")) == "STRING")
    )
    stripped = F.transform(
        F.try_variant_get(document, "$.evidence", "array<string>"), lambda item: strip(item)
    )
    kept = F.slice(F.filter(stripped, lambda item: item != ""), 1, EVIDENCE_ITEMS)
    evidence = F.transform(kept, lambda item: F.substring(item, 1, EVIDENCE_CHARS))

    reason_kind = _type_at(document, "$.justification")
    reason_ok = reason_kind.isNull() | (reason_kind == "STRING")
    reason = F.substring(
        strip(F.try_variant_get(document, "$.justification", "string")), 1, JUSTIFICATION_CHARS
    )

    valid = F.coalesce(label_ok & score_ok & evidence_ok & reason_ok, F.lit(False))
    error = (
        F.when(document.isNull(), NOT_JSON)
        .when(~kind.startswith("OBJECT"), NOT_OBJECT)
        .when(~valid, BAD_SCHEMA)
    )
    accepted = error.isNull()
    nothing = F.array().cast("array<string>")
    return F.struct(
        F.when(accepted, label).alias("label"),
        F.when(accepted, score).alias("score"),
        F.when(accepted, F.coalesce(evidence, nothing)).otherwise(nothing).alias("evidence"),
        F.when(accepted, F.coalesce(reason, F.lit(""))).otherwise("").alias("justification"),
        error.alias("error"),
    )


def evidence_json(evidence: Column) -> Column:
    """Evidence as JSON text with the separators of the stored result files."""
    quoted = F.transform(evidence, lambda item: F.regexp_extract(
        F.to_json(F.array(item)), r"(?s)^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
