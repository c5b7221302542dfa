import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import bundles, similarity


def wide(sales):
    table = sales.toPandas().pivot_table(index="date", columns="product_id", values="units_sold", aggfunc="mean")
    return table.sort_index().fillna(table.mean())


@pytest.fixture(scope="module")
def gappy(sales):
    """Sales with days missing at random per product, and one product without variance."""
    kept = sales.where(F.pmod(F.xxhash64("product_id", "date"), F.lit(5)) > 0)
    flat = kept.where("product_id = 'K01'").withColumn("product_id", F.lit("FLAT")).withColumn(
        "units_sold", F.lit(3).cast("long"))
    return kept.unionByName(flat)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("products", [7, 500])
def test_pairs_match_pandas(gappy, method, products):
    table = wide(gappy)
    expected = table.corr() if method == "pearson" else table.rank().corr()
    rows = similarity.product_pairs(gappy, products, method=method).collect()
    assert len(rows) == 7 * 6 // 2
    for r in rows:
        assert r.product_a < r.product_b and "FLAT" not in (r.product_a, r.product_b)
        assert r.similarity == pytest.approx(expected.loc[r.product_a, r.product_b], abs=1e-9)


def test_matrix_is_symmetric_with_unit_diagonal(sales):
    pairs = similarity.product_pairs(sales, 7)
    rows = similarity.similarity_matrix(pairs, sales.select("product_id").distinct()).collect()
    matrix = {(r.product_a, r.product_b): r.similarity for r in rows}
    assert len(matrix) == 49 and all(matrix[a, b] == matrix[b, a] for a, b in matrix)
    assert all(matrix[a, a] == 1.0 for a, _ in matrix)


def test_pivot_has_dates_by_products(gappy):
    ids = ["K01", "K04"]
    got = similarity.sales_pivot(gappy, ids).orderBy("date").toPandas()
    expected = wide(gappy)
    assert len(got) == len(expected)
    np.testing.assert_allclose(got[ids].to_numpy(), expected[ids].to_numpy(), atol=1e-9)


def test_best_pairs_per_block_contain_the_overall_best(sales):
    catalog = sales.select("product_id", "product_name", "category").distinct()
    all_pairs = bundles.best_pairs(similarity.product_pairs(sales, 7, digits=3), 5).collect()
    few = bundles.recommend(sales, catalog, 500).collect()
    assert [(r.product_a, r.product_b, r.similarity) for r in few] == [tuple(r) for r in all_pairs if r.similarity >= 0]


def test_bundles_have_positive_sales(sales):
    catalog = sales.select("product_id", "product_name", "category").distinct()
    rows = bundles.with_sales_impact(bundles.recommend(sales, catalog, 7, min_similarity=-1.0), sales).collect()
    assert len(rows) == 5 and all(-1 <= r.similarity <= 1 for r in rows)
    assert all(r.bundle_avg_daily_sales == round(r.avg_daily_sales_a + r.avg_daily_sales_b, 2) > 0 for r in rows)
