import pytest
from conftest import account, by_key, rows_of, to_table

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q
from tenura.operators import cleaning


def test_input_is_not_changed(raw):
    before = rows_of(raw.orderBy("customerID"))
    cleaning.clean(raw).collect()
    assert rows_of(raw.orderBy("customerID")) == before


@pytest.mark.parametrize("column", ["Partner", "Dependents", "Churn"])
def test_yes_no_columns_become_codes(cleaned, raw, column):
    codes, texts = by_key(cleaned, "customerID", column), by_key(raw, "customerID", column)
    assert all(codes[k] == (1 if texts[k] == "Yes" else 0) for k in texts)


def test_text_columns_are_strings(cleaned):
    types = dict(cleaned.dtypes)
    assert all(types[c] == "string" for c in config.TEXT_COLUMNS)


def test_padded_answers_are_trimmed(spark):
    row = cleaning.clean(
        to_table(spark, [account("X1", Partner=" Yes ", Dependents=" No ", Churn="\tYes ")])
    ).first()
    assert (row["Partner"], row["Dependents"], row["Churn"]) == (1, 0, 1)


def test_unmapped_answers_are_null(spark):
    row = cleaning.clean(to_table(spark, [account("X1", Partner="maybe", Churn=None)])).first()
    assert row["Partner"] is None and row["Churn"] is None


@pytest.mark.parametrize(
    "text,number",
    [("12", 12.0), (" 7.5 ", 7.5), ("-3", -3.0), ("1e2", 100.0), (".5", 0.5), ("inf", float("inf")),
     ("12d", None), ("", None), (" ", None), ("nan", None), (None, None), ("1,000", None)],
)
def test_numeric_coercion(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.to_number(q("t")).alias("n")).first()["n"] == number


def test_blank_total_becomes_zero(cleaned):
    assert by_key(cleaned, "customerID", "TotalCharges")["A-03"] == 0.0


def test_summary_counts_repeats(spark):
    df = to_table(spark, [account("K1"), account("K1"), account("K2"), account(None)])
    row = cleaning.cleaning_summary(cleaning.clean(df)).first()
    assert tuple(row) == (4, 1, 2)
