import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from synth import SCHEMA, cohort

from strataflux.functions.multiplicity import with_fdr
from strataflux.functions.robust import with_robust_z
from strataflux.operators import confound, harmonize, mixed

COVARIATES = ["age_baseline", "sex", "dx_baseline", "time_from_baseline_years"]


def reference_combat(df, eb=True):
    """Direct location-scale adjustment with one design matrix per feature, in NumPy."""
    features = sorted(df.region.unique())
    batches = sorted(df.site.unique())
    store, g, d, n = {}, {}, {}, {}
    for f in features:
        x = df[df.region == f]
        b = np.stack([(x.site == k).to_numpy(float) for k in batches], 1)
        c = np.stack([x.age_baseline, x.sex == "M", x.dx_baseline == "patient", x.time_from_baseline_years], 1).astype(float)
        design, y = np.hstack([b, c]), x.value.to_numpy()
        coef = np.linalg.lstsq(design, y, rcond=None)[0]
        sizes = b.sum(0)
        grand = sizes @ coef[: len(batches)] / sizes.sum()
        sigma = math.sqrt(((y - design @ coef) ** 2).mean())
        preserved = grand + c @ coef[len(batches) :]
        z = (y - preserved) / sigma
        store[f] = (x, preserved, sigma, z)
        for i, k in enumerate(batches):
            own = z[b[:, i] == 1]
            g[f, k], d[f, k], n[f, k] = own.mean(), own.var(ddof=1), len(own)
    gs, ds = dict(g), dict(d)
    if eb:
        for k in batches:
            gh, dh = np.array([g[f, k] for f in features]), np.array([d[f, k] for f in features])
            t2, m, v = gh.var(ddof=1), dh.mean(), dh.var(ddof=1)
            a, r = (2 * v + m * m) / v, (m * v + m**3) / v
            for i, f in enumerate(features):
                x, _, _, z = store[f]
                own = z[(x.site == k).to_numpy()]
                gg, dd = gh[i], dh[i]
                for _ in range(200):
                    gg = (len(own) * t2 * gh[i] + dd * gh.mean()) / (len(own) * t2 + dd)
                    dd = (0.5 * ((own - gg) ** 2).sum() + r) / (len(own) / 2 + a - 1)
                gs[f, k], ds[f, k] = gg, dd
    parts = []
    for f in features:
        x, preserved, sigma, z = store[f]
        gk, dk = np.array([gs[f, k] for k in x.site]), np.array([ds[f, k] for k in x.site])
        parts.append(x.assign(want=(z - gk) / np.sqrt(dk) * sigma + preserved))
    return pd.concat(parts), gs, ds


@pytest.mark.parametrize("eb", [True, False])
def test_combat_equals_direct_computation(spark, eb):
    rows = cohort(60, 4, seed=3)
    want, gs, ds = reference_combat(pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]), eb)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("batch", F.col("site"))
    adjusted, params, design = harmonize.combat(df, COVARIATES, empirical_bayes=eb, tolerance=1e-12, max_iterations=500)
    got = adjusted.toPandas().merge(want, on=["subject_id", "session_id", "region"])
    assert len(got) == len(rows) and np.abs(got.value_adjusted - got.want).max() < 1e-6
    for r in params.collect():
        assert abs(r.gamma_star - gs[r.region, r.batch]) < 1e-6 and abs(r.delta_star - ds[r.region, r.batch]) < 1e-6
    assert design.names == ["x_age_baseline", "x_sex_1", "x_dx_baseline_1", "x_time_from_baseline_years"]


def test_shrinkage_pools_across_features_within_a_batch(spark):
    df = spark.createDataFrame(cohort(60, 3, seed=5), SCHEMA).withColumn("batch", F.col("site"))
    _, params, _ = harmonize.combat(df, COVARIATES)
    p = params.toPandas()
    moved = (p.gamma_star - p.gamma).abs().max()
    by_feature = p.assign(batch_=p.region, region_=p.batch).groupby("batch_", group_keys=False)[p.columns.tolist()].apply(
        lambda g: harmonize.shrink_batch(g.drop(columns=["gamma_star", "delta_star", "iterations", "converged"])).set_index(g.index)
    )
    assert moved > 0 and (by_feature.gamma_star - p.gamma_star).abs().max() > 1e-3


def test_combat_skips_and_leaves_rows_alone(spark):
    rows = [(f"s{i}", "v", "a", "r1", "volume", 1.0 * i, 0.0, 60.0 + i, "F", "control", 1e6) for i in range(8)]
    rows += [(f"s{i}", "v", "ab"[i % 2], "r2", "volume", 5.0, 0.0, 60.0 + i, "F", "control", 1e6) for i in range(8)]
    rows += [(f"s{i}", "v", "ab"[i % 2] if i < 8 else "c", "r3", "volume", 5.0 + i % 3 + i % 2, 0.0, None if i == 0 else 60.0 + i, "F", "control", 1e6) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("batch", F.col("site"))
    adjusted, params, design = harmonize.combat(df, ["age_baseline", "sex", "absent"])
    skips = {r.region: r.skip for r in params.collect()}
    assert skips["r1"] == "single_batch" and skips["r2"] == "zero_variance" and skips["r3"] == ""
    assert design.dropped == {"absent": "absent_from_observations", "sex": "constant"}
    got = {(r.region, r.subject_id): (r.value, r.value_adjusted) for r in adjusted.collect()}
    assert got["r1", "s3"] == (3.0, 3.0) and got["r3", "s0"][0] == got["r3", "s0"][1] and got["r3", "s8"][0] == got["r3", "s8"][1]
    assert got["r3", "s2"][0] != got["r3", "s2"][1]


def test_site_effect_goes_and_slopes_stay(spark):
    df = spark.createDataFrame(cohort(90, 4, seed=9), SCHEMA).withColumn("batch", F.col("site"))
    adjusted, _, _ = harmonize.combat(df, COVARIATES)
    p = adjusted.filter("region = 'lh-putamen'").toPandas()
    gap = lambda c: p.groupby("site")[c].mean().max() - p.groupby("site")[c].mean().min()
    assert gap("value") > 1.2 and gap("value_adjusted") < 0.4
    slope = lambda c: np.polyfit(p.time_from_baseline_years, p[c] - p.groupby("subject_id")[c].transform("mean"), 1)[0]
    assert abs(slope("value_adjusted") / slope("value") - 1) < 0.15


def dense_objective(df, psi):
    """-2 restricted log likelihood, coefficients and standard errors from the dense covariance of every subject."""
    x_all, y_all, v_all = [], [], []
    for _, s in df.groupby("subject_id"):
        t = s.time.to_numpy()
        z = np.stack([np.ones_like(t), t], 1)
        dx, sex = s.dx.to_numpy(), s.sex.to_numpy()
        x_all.append(np.stack([np.ones_like(t), s.age, t, dx, t * dx, sex, s.etiv], 1))
        y_all.append(s.value.to_numpy())
        v_all.append(np.eye(len(t)) + z @ psi @ z.T)
    a = sum(x.T @ np.linalg.solve(v, x) for x, v in zip(x_all, v_all))
    b = sum(x.T @ np.linalg.solve(v, y) for x, y, v in zip(x_all, y_all, v_all))
    beta = np.linalg.solve(a, b)
    rss = sum((y - x @ beta) @ np.linalg.solve(v, y - x @ beta) for x, y, v in zip(x_all, y_all, v_all))
    n, p = len(df), len(beta)
    value = sum(np.linalg.slogdet(v)[1] for v in v_all) + np.linalg.slogdet(a)[1] + (n - p) * math.log(rss / (n - p))
    return value, beta, np.sqrt(np.diag(np.linalg.inv(a)) * rss / (n - p))


def test_restricted_likelihood_equals_dense_computation(spark):
    rows = spark.createDataFrame(cohort(30, 4, seed=11), SCHEMA)
    model = mixed.model_rows(rows).filter("region = 'lh-putamen'")
    sums, dense = mixed.subject_sums(model).toPandas(), model.toPandas()
    factor = np.array([[1.3, -0.2, 0.4]])
    low = np.array([[1.3, 0.0], [-0.2, 0.4]])
    value, beta, cov, _ = mixed.objective(mixed.partial_likelihood(sums, factor)[0], sums.n.sum())
    want, want_beta, want_se = dense_objective(dense, low @ low.T)
    assert abs(value - want) < 1e-6
    assert np.allclose(beta + np.r_[sums.center[0], np.zeros(6)], want_beta, rtol=1e-7) and np.allclose(np.sqrt(np.diag(cov)), want_se, rtol=1e-7)


def test_mixed_model_recovers_slopes(spark):
    rows = spark.createDataFrame(cohort(90, 4, seed=13, site_effects=False), SCHEMA)
    rows = rows.unionByName(rows.filter("subject_id < 's002' AND region = 'lh-putamen'").withColumn("region", F.lit("few")))
    rows = rows.unionByName(rows.filter("region = 'lh-putamen'").withColumns({"region": F.lit("flat"), "time_from_baseline_years": F.lit(0.0)}))
    fits = mixed.fit_regions(rows).toPandas()
    state = fits.drop_duplicates("region").set_index("region")
    assert state.reason["few"] == "too_few_subjects" and state.reason["flat"] == "constant_time" and state.n_observations["flat"] == 0
    good = fits[fits.estimable]
    assert good.converged.all() and good.region.nunique() == 6
    primary = good[good.term == mixed.PRIMARY]
    assert (np.abs(primary.estimate + 0.5) < 3.5 * primary.se).all() and (np.abs(primary.estimate + 0.5) / 0.5).median() < 0.2
    slope = good[good.term == "time"]
    assert (np.abs(slope.estimate + 0.3) < 3.5 * slope.se).all()
    assert np.allclose(primary.p_value, [math.erfc(abs(e / s) / math.sqrt(2)) for e, s in zip(primary.estimate, primary.se)])
    table = mixed.results_table(spark.createDataFrame(fits.astype(object).where(fits.notna(), None).values.tolist(), mixed.FITS)).toPandas()
    assert len(table) == 8 and table.q_value.notna().sum() == 6 and (table.q_value.dropna() >= table.p_value.dropna()).all()


def test_fits_take_few_jobs_and_arms_equal_single_fits(spark):
    rows = spark.createDataFrame(cohort(40, 4, seed=17), SCHEMA).filter("region < 'lh-t'")
    rows = rows.unionByName(rows.filter("region = 'lh-putamen'").withColumns({"region": F.lit("flat"), "sex": F.lit("M")}))
    rows = rows.withColumn("other", F.when(F.col("subject_id") != "s001", F.col("value") * 2 + F.col("time_from_baseline_years") * (F.col("dx_baseline") == "patient").cast("double")))
    spark.sparkContext.setJobGroup("fits", "jobs of one fit")
    single = mixed.fit_regions(rows)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fits"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 15  # a job or more for each of some 15 passes before
    frame = lambda df: df.toPandas().sort_values(["region", "term"]).reset_index(drop=True)
    want = {"a": frame(single), "b": frame(mixed.fit_regions(rows.withColumn("value", F.col("other"))))}
    assert set(want["a"].reason[want["a"].region == "flat"]) == {"singular_design"} and want["a"].converged.sum() == 14
    for whole in (mixed.WHOLE_REGION, 0):
        for arm, fits in mixed.fit_arms(rows, {"a": "value", "b": "other"}, whole=whole).items():
            pd.testing.assert_frame_equal(frame(fits), want[arm], rtol=1e-5, atol=1e-7, check_dtype=False)
    assert (want["b"].n_subjects == 39).all() and (want["a"].n_subjects == 40).all()


def test_fdr_known_values_and_families(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.03]
    rows = [("a", x, True) for x in p] + [("a", 0.0001, False), ("a", None, True), ("b", 0.2, True)]
    got = with_fdr(spark.createDataFrame(rows, "f string, p_value double, ok boolean"), ["f"], testable="ok").collect()
    q = {(r.f, r.p_value, r.ok): r.q_value for r in got}
    want = {0.005: 0.025, 0.01: 0.025, 0.03: 0.0375, 0.04: 0.04}
    for x, v in want.items():
        assert abs(q["a", x, True] - v) < 1e-12
    assert q["a", 0.0001, False] is None and q["a", None, True] is None and q["b", 0.2, True] == 0.2


def test_robust_z_degenerate_groups(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", None), ("flat", 5.0), ("flat", 5.0), ("flat", 9.0), ("flat", None), ("none", None), (None, 1.0), (None, 4.0)]
    got = with_robust_z(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], "z").collect()
    z = {(r.g, r.v): r.z for r in got}
    assert abs(z["a", 3.0] - 1 / 1.4826) < 1e-12 and z["a", None] is None
    assert z["flat", 9.0] == 0.0 and z["flat", None] == 0.0 and z["none", None] == 0.0
    assert abs(z[None, 4.0] - 1.5 / (1.4826 * 1.5)) < 1e-12


def test_confounding_severity_and_policies(spark):
    rows = [(f"s{i}", "v", "ab"[i % 2], "r", "volume", 1.0, float(i % 2) + (i % 4) / 50, 60.0, "F", "control", 1e6) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"scanner_manufacturer": F.lit("M"), "scanner_model": F.lit("1"), "field_strength_tesla": F.lit(3.0)})
    one = confound.severity(df, "site").first()
    assert one.severity == "severe" and not one.interpretable and abs(one.correlation - 1) < 0.01
    assert confound.severity(df.filter("site = 'a'"), "site").first().severity == "not_assessable"
    assert {r.batch: (r.bin_0, r.bin_3) for r in confound.time_crosstab(df, "site").collect()} == {"a": (20, 0), "b": (0, 20)}
    odd = df.unionByName(df.limit(3).withColumn("site", F.lit("c"))).unionByName(df.limit(2).withColumn("site", F.lit("d")))
    pooled = {(r.batch, r.estimable) for r in confound.batch_policy(odd, "site", 5, "pool").collect()}
    assert ("pool:c+d", True) in pooled and ("a", True) in pooled
    kept = {(r.batch, r.estimable) for r in confound.batch_policy(odd, "site", 5, "report_and_exclude").collect()}
    assert ("c", False) in kept and ("a", True) in kept
    assert all(r.estimable for r in confound.batch_policy(odd, "site", 5, "passthrough").collect())
