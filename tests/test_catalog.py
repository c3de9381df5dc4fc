import pytest

from fiscora.catalog import ENDPOINTS, GOLD_SCHEMA, column_name
from fiscora.operators.quality import schema_mismatches
from fiscora.plans import silver
from fiscora.sources.bronze import empty_staging


@pytest.mark.parametrize(
    ("endpoint", "columns", "fields"),
    [
        ("overview", 59, 54),
        ("income_statement", 34, 24),
        ("balance_sheet", 47, 36),
        ("cash_flow", 38, 28),
        ("earnings", 14, 4),
    ],
)
def test_catalogue_sizes(endpoint, columns, fields):
    spec = ENDPOINTS[endpoint]
    assert len(spec.columns) == len(set(spec.columns)) == columns
    assert len(spec.fields) == len({f.source for f in spec.fields}) == fields
    assert all(f.column in spec.columns for f in spec.fields)
    assert len(GOLD_SCHEMA) == 29


@pytest.mark.parametrize(
    ("source", "column"),
    [
        ("totalRevenue", "total_revenue"),
        ("PERatio", "pe_ratio"),
        ("EVToEBITDA", "ev_to_ebitda"),
        ("DilutedEPSTTM", "diluted_epsttm"),
        ("52WeekHigh", "week_high_52"),
        ("200DayMovingAverage", "moving_average_200"),
        ("accumulatedDepreciationAmortizationPPE", "accumulated_depreciation_amortization_ppe"),
        ("costofGoodsAndServicesSold", "cost_of_goods_and_services_sold"),
        ("fiscalDateEnding", "fiscaldateending"),
    ],
)
def test_column_names(source, column):
    assert column_name(source) == column


@pytest.mark.parametrize("endpoint", list(ENDPOINTS))
def test_models_match_the_catalogue(spark, endpoint):
    model = silver.MODELS[endpoint](empty_staging(spark))
    assert schema_mismatches(model, ENDPOINTS[endpoint].schema) == []


def test_schema_mismatches_are_named(spark):
    frame = spark.createDataFrame([], "symbol string, extra int")
    found = schema_mismatches(frame, ENDPOINTS["overview"].schema)
    assert "undeclared extra: int" in found
    assert "missing pe_ratio: decimal(38,9)" in found
