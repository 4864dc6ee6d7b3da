"""A generator of nested report documents, as fixtures: cyclic choices from word lists, so the same row gives the same text.

With the sections' usual counts and PASSAGES sentences a text field a report has about 1.87 MB, as those that the
studied system was shown with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THEMES = ("capacity", "pricing", "staffing", "compliance", "logistics", "demand")
BUYERS = ("operators", "lenders", "retailers", "public bodies")
HORIZONS = ("this year", "next year", "within five years")
#: The sections of a report that are lists of objects, with their items and text fields.
SECTIONS = (
    ("market_segments_detailed", 30, ("segment_name", "segment_theme", "revenue_share_commentary", "buyer_profile", "pricing_model", "operating_model")),
    ("representative_companies", 20, ("company_archetype", "positioning_statement", "commercial_strategy")),
    ("key_performance_indicators", 24, ("metric_name", "definition", "management_use", "warning_pattern")),
    ("structural_trends_expanded", 20, ("trend_title", "market_description", "operator_implications", "investor_interpretation")),
    ("regulatory_and_compliance_map", 15, ("regulation_theme", "summary", "cost_effect", "strategic_response")),
    ("supply_chain_dependencies", 15, ("input_name", "sourcing_context", "price_sensitivity", "substitution_pathways")),
    ("regional_market_profiles", 12, ("region_name", "demand_conditions", "cost_profile", "entry_strategy")),
    ("industry_aspects_expanded", 20, ("aspect_name", "management_relevance", "investor_takeaway")),
    ("trend_map", 16, ("trend_name", "trend_summary", "commercial_impact", "credit_relevance")),
    ("risk_matrix", 20, ("risk_name", "risk_description", "early_warning_signals", "mitigants")),
    ("buyer_personas", 12, ("persona_name", "procurement_style")),
    ("industry_glossary", 30, ("term", "definition", "usage_note")),
)
#: The sections that are lists of texts, with their items.
LISTS = (("executive_summary", 18), ("stability_watchpoints", 24), ("interview_guide_topics", 70), ("research_questions", 70), ("appendix", 135))
PASSAGES = 22


def cyclic(values: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def passage(subject: Column, at: Column, sentences: int = 1) -> Column:
    one = lambda k: F.format_string("%s shapes %s for %s %s (note %d).", cyclic(THEMES, at + k), subject, cyclic(BUYERS, at + k + 1), cyclic(HORIZONS, at + k + 2), (at + k).cast("int"))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(sentences - 1)), one), " ")


def reports(spark: SparkSession, n: int, share: float = 0.01, sentences: int = 2) -> DataFrame:
    """(report_id, content): JSON text in the order of fields that a writer would give. share: of each section's items."""
    at, name = F.col("id"), F.format_string("Industry %d", F.col("id"))
    places = lambda items: F.sequence(F.lit(1), F.lit(max(2, round(items * share))))

    def section(k: int, title: str, items: int, fields: tuple[str, ...]) -> Column:
        item = lambda i: F.struct(
            F.format_string("%s-%d-%d", F.lit(title[:3]), at, i).alias("segment_id"), *(passage(name, at * 31 + i * 7 + k + j, sentences).alias(f) for j, f in enumerate(fields)), F.array(passage(name, i), passage(name, i + 1)).alias("risk_notes")
        )
        return F.transform(places(items), item).alias(title)

    body = F.struct(
        F.format_string("sample-%03d", at).alias("report_id"), name.alias("title"), F.lit("v1").alias("source_version"), F.lit("2026-01-01").alias("report_date"),
        *(F.transform(places(items), lambda i, k=k: passage(name, at * 17 + i + k, sentences)).alias(title) for k, (title, items) in enumerate(LISTS)),
        *(section(100 * k, *of) for k, of in enumerate(SECTIONS)),
    )
    return spark.range(n).select(F.format_string("sample-%03d", at).alias("report_id"), F.to_json(body).alias("content"))


def verbose_reports(spark: SparkSession, n: int) -> DataFrame:
    """Reports of the usual size."""
    return reports(spark, n, 1.0, PASSAGES)
