"""Quality rules: the determinant against many random starts, and rows with null or repeated ids."""

import numpy as np

from conftest import SF_SMALL
from forumlens.llm import quality_mcd

STATS = "lang string, source string, base_failed boolean, q0 long, q1 long, q2 long, q3 long, q4 long"


def best_volume(z, keep, starts, rng):
    """The smallest determinant (half its log) that concentration steps reach from random starts."""
    ridge = np.diag(np.square(quality_mcd.FLOORS))
    best = np.inf
    for _ in range(starts):
        near = rng.choice(len(z), 8, replace=False)
        for _ in range(40):
            mu, cov = z[near].mean(0), np.cov(z[near].T, bias=True) * quality_mcd.CONSISTENCY + ridge
            d2 = np.einsum("ij,jk,ik->i", z - mu, np.linalg.inv(cov), z - mu)
            again = np.argsort(d2, kind="stable")[:keep]
            if len(again) == len(near) and set(again) == set(near):
                break
            near = again
        best = min(best, 0.5 * np.linalg.slogdet(cov)[1])
    return best


def test_determinant_is_as_small_as_from_many_random_starts(spark):
    rng = np.random.default_rng(3)
    wide = rng.normal(0, 1, (400, 5)) @ np.triu(rng.normal(0, 6, (5, 5)))
    shifted = np.r_[wide[:300], rng.normal(90, 2, (100, 5))]
    for q in (np.rint(wide).astype(int), np.rint(shifted).astype(int)):
        stats = spark.createDataFrame([("en", "s", False, *map(int, x)) for x in q], STATS)
        fit = quality_mcd.estimates(stats).filter("k.level = 2").first()
        assert fit["volume"] <= best_volume(q / quality_mcd.GRID, 300, 60, rng) + 0.02


def test_consistency_factor():
    z = np.random.default_rng(0).normal(size=(400_000, 5))
    near = z[np.argsort((z * z).sum(1))[:300_000]]
    assert abs(1 / near.var(axis=0).mean() - quality_mcd.CONSISTENCY) < 0.01


def test_repeated_and_null_ids_are_decided_by_their_own_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good = docs.join(quality_mcd.judge(docs).filter("kept").select("doc_id"), "doc_id").select(docs.columns).first()
    bad = (good.doc_id, "# * $ " * 100, good.lang, good.source, 1)
    more = spark.createDataFrame([bad, (None, *bad[1:]), (None, *good[1:]), tuple(good)], docs.schema)
    out = quality_mcd.keep_good(docs.union(more))
    assert out.columns == docs.columns
    assert out.filter("text like '# * $%'").count() == 0
    assert out.filter(out["text"] == good.text).count() == 3


def test_stage_plan_does_not_copy_the_factorisation(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = quality_mcd.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000
