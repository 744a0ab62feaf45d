"""Longitudinal mixed models per region: restricted likelihood with a random intercept and slope per subject.

Every fixed effect is a constant of the subject times 1 or time, so a subject enters by six sums. The likelihood
of a set of candidate variance parameters is a sum over subjects. Regions of at most WHOLE_REGION subjects are searched
in one task each, all of them in one job. For greater ones one pass over the sums evaluates all candidates of all
regions; the driver only sees one small matrix per region and candidate, and picks the next ones. Both take the same steps.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.session import materialize

# fixed values: terms of the model and those that form families of tests
TERMS = ("Intercept", "age_baseline", "time", "dx_baseline[T.patient]", "time:dx_baseline[T.patient]", "sex[T.M]", "etiv_baseline")
PRIMARY = "time:dx_baseline[T.patient]"
SECONDARY = ("time", "dx_baseline[T.patient]", "age_baseline")
P = len(TERMS)
MIN_SUBJECTS = 3
SEARCH_PASSES = 30
REGION_LIMIT = 10_000
#: subjects of a region that one task searches; with two arms 16 numbers each, 32 MB
WHOLE_REGION = 250_000
CHUNK = 2_048
SUMS = ("n", "t", "tt", "y", "ty", "yy")
UNIT = ("age", "dx", "sex", "etiv")


def model_rows(observations: DataFrame, values: Sequence[str] = ("value",)) -> DataFrame:
    """(region, measure_type, subject_id, `values`, time, age, dx, sex, etiv) of rows that are complete; eTIV in 1e6, dx and sex as 0/1.

    Other diagnoses than patient and control, and other sexes than F and M, are incomplete. Of several values one has to be there.
    """
    dx = F.when(F.col("dx_baseline") == "patient", 1.0).when(F.col("dx_baseline") == "control", 0.0)
    sex = F.when(F.col("sex") == "M", 1.0).when(F.col("sex") == "F", 0.0)
    rows = observations.select(
        "region", "measure_type", "subject_id", *values, F.col("time_from_baseline_years").alias("time"), F.col("age_baseline").alias("age"),
        dx.alias("dx"), sex.alias("sex"), (F.col("etiv_baseline") / 1e6).alias("etiv"),
    )
    return rows.dropna(subset=[c for c in rows.columns if c not in values]).dropna(how="all", subset=list(values))


def is_complete() -> Column:
    """True for rows that `model_rows` keeps."""
    numbers = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in ("value", "time_from_baseline_years", "age_baseline", "etiv_baseline")]
    known = F.col("dx_baseline").isin("patient", "control") & F.col("sex").isin("M", "F")
    for n in numbers:
        known = known & n
    return F.coalesce(known, F.lit(False)) & F.col("region").isNotNull() & F.col("measure_type").isNotNull() & F.col("subject_id").isNotNull()


def _of_arm(i: int) -> list[str]:
    """The names of the sums of the i-th value."""
    return [f"{c}_{i}" if i else c for c in SUMS]


def subject_sums(rows: DataFrame, values: Sequence[str] = ("value",)) -> DataFrame:
    """Six sums per value, region, subject and covariate values; values are centred per region, all by the means of the first.

    Covariates are constants of a subject; where they aren't, the subject falls apart into one unit per value set.
    """
    time = F.col("time")
    known = {c: F.when(~F.isnan(c), F.col(c)) for c in values}
    # stored, so that its size is known and the rows don't travel for it
    centers = materialize(rows.groupBy("region", "measure_type").agg(F.coalesce(*[F.avg(v) for v in known.values()]).alias("center")), "centers")
    sums = []
    for i, value in enumerate(known.values()):
        v = value - F.col("center")
        there = F.when(v.isNotNull(), time)
        parts = (F.count(v).cast("double"), F.sum(there), F.sum(there * time), F.sum(v), F.sum(v * time), F.sum(v * v))
        sums += [p.alias(name) for p, name in zip(parts, _of_arm(i))]
    return rows.join(centers, ["region", "measure_type"]).groupBy("region", "measure_type", "center", "subject_id", *UNIT).agg(*sums)


def partial_likelihood(s: pd.DataFrame, factors: np.ndarray) -> np.ndarray:
    """For each candidate factor (l11, l21, l22): log determinant, yVy, XVX (P x P) and XVy, summed over the subjects of `s`.

    Let Z be a subject's [[n, t], [t, tt]], and L the factor with LL' = psi. The determinant is det(I + L'ZL) = 1 + tr(psi Z) + det(psi) det(Z),
    and L (I + L'ZL)^-1 L' = (psi + det(psi) adj(Z)) / det, so all candidates weigh the same products of the subject by 1 / det.
    """
    l11, l21, l22 = np.asarray(factors, dtype=float).T
    psi = (l11 * l11, l11 * l21, l21 * l21 + l22 * l22, l11 * l11 * l22 * l22)
    of_det = np.stack([np.ones_like(l11), psi[0], 2 * psi[1], psi[2], psi[3]], axis=1)
    i, j = np.triu_indices(P + 1)
    logs, plain, weighed = np.zeros(len(l11)), np.zeros(len(i)), np.zeros((len(l11), 4 * len(i)))
    columns = s[[*SUMS, *UNIT]].to_numpy(float).T
    for at in range(0, columns.shape[1], CHUNK):
        n, t, tt, y, ty, yy, age, dx, sex, etiv = np.ascontiguousarray(columns[:, at : at + CHUNK])
        one, zero = np.ones_like(n), np.zeros_like(n)
        # a fixed effect is a + b * time with constants a and b per subject
        a = np.stack([one, age, zero, dx, zero, sex, etiv])
        b = np.stack([zero, zero, one, zero, dx, zero, zero])
        # Z'X and, as its last row, Z'y
        u, v = np.vstack([a * n + b * t, y]), np.vstack([a * t + b * tt, ty])
        square = np.vstack([a, zero])[i] * u[j] + np.vstack([b, zero])[i] * v[j]  # X'X and X'y
        spread = np.maximum(n * tt - t * t, 0.0)
        turned = square * spread  # adj(Z) Z = det(Z) I
        turned[-1] = tt * y * y - 2 * t * y * ty + n * ty * ty
        square[-1] = yy
        det = of_det @ np.stack([one, n, t, tt, spread])
        logs += np.log(det).sum(axis=1)
        plain += square.sum(axis=1)
        weighed += (1 / det) @ np.concatenate([u[i] * u[j], u[i] * v[j] + v[i] * u[j], v[i] * v[j], turned]).T
    left = plain - sum(p[:, None] * w for p, w in zip(psi, np.split(weighed, 4, axis=1)))
    both = np.empty((len(l11), P + 1, P + 1))
    both[:, i, j] = both[:, j, i] = left
    return np.concatenate([logs[:, None], both[:, P, P, None], both[:, :P, :P].reshape(len(l11), P * P), both[:, :P, P]], axis=1)


def objective(total: np.ndarray, n: float) -> tuple[float, np.ndarray, np.ndarray, float]:
    """(-2 restricted log likelihood up to a constant, coefficients, their covariance, residual variance)."""
    x = total[2 : 2 + P * P].reshape(P, P)
    xy = total[2 + P * P :]
    scale = np.sqrt(np.maximum(np.diag(x), 1e-300))
    sign, logdet = np.linalg.slogdet(x / np.outer(scale, scale))
    if sign <= 0 or logdet < -60:
        return math.inf, np.full(P, np.nan), np.full((P, P), np.nan), math.nan
    inverse = np.linalg.inv(x / np.outer(scale, scale)) / np.outer(scale, scale)
    beta = inverse @ xy
    sigma2 = max(float(total[1] - beta @ xy) / (n - P), 1e-300)
    return float(total[0] + logdet + 2 * np.log(scale).sum() + (n - P) * math.log(sigma2)), beta, inverse * sigma2, sigma2


def _evaluate(sums: DataFrame, candidates: dict[tuple[str, str], np.ndarray]) -> dict[tuple[str, str], np.ndarray]:
    width = 2 + P * P + P

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby(["region", "measure_type"], sort=False):
                if key in candidates:
                    part = partial_likelihood(rows, candidates[key])
                    held[key] = held[key] + part if key in held else part
        out = [(*key, c, *row) for key, parts in held.items() for c, row in enumerate(parts)]
        if out:
            yield pd.DataFrame(out, columns=["region", "measure_type", "c", *[f"s{i}" for i in range(width)]])

    schema = "region string, measure_type string, c int, " + ", ".join(f"s{i} double" for i in range(width))
    totals = sums.mapInPandas(partial, schema).groupBy("region", "measure_type", "c").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])
    found: dict[tuple[str, str], np.ndarray] = {k: np.full((len(v), width), np.nan) for k, v in candidates.items()}
    for r in totals.collect():
        found[(r.region, r.measure_type)][r.c] = r[3:]
    return found


def _allowed(factors: np.ndarray) -> np.ndarray:
    """The diagonal of a factor isn't negative."""
    factors = np.array(factors, dtype=float)
    factors[..., [0, 2]] = np.maximum(factors[..., [0, 2]], 0.0)
    return factors


def _next_center(points: np.ndarray, values: np.ndarray, best: np.ndarray, step: float) -> tuple[np.ndarray, float]:
    """Where to look next: the minimum of a quadratic through the grid's values, else the best point so far."""
    center, scale = points[0], step * np.maximum(np.abs(points[0]), 0.05)
    u = (points - center) / scale
    if np.isfinite(values).all():
        cross = [u[:, i] * u[:, j] for i in range(3) for j in range(i, 3)]
        c = np.linalg.lstsq(np.stack([np.ones(len(u)), *u.T, *cross], 1), values, rcond=None)[0]
        h = np.array([[2 * c[4], c[5], c[6]], [c[5], 2 * c[7], c[8]], [c[6], c[8], 2 * c[9]]])
        if np.linalg.eigvalsh(h)[0] > 0:
            move = -np.linalg.solve(h, c[1:4])
            if np.abs(move).max() <= 1.5:
                return _allowed(center + move * scale), step / 3
    edge = np.abs((best - center) / scale).max() >= 0.99
    return best, step if edge else step / 3


FITS = (
    "region string, measure_type string, n_observations bigint, n_subjects bigint, estimable boolean, converged boolean, "
    "random_slope_dropped boolean, reason string, sigma2 double, var_intercept double, cov_slope double, var_slope double, "
    "term string, estimate double, se double, p_value double"
)


START = np.array([(a, b, c) for a in (0.3, 1.0, 3.0) for b in (0.0,) for c in (0.03, 0.3, 1.0)] + [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0)])
MOVES = np.array(list(itertools.product((0, -1, 1), repeat=3)), dtype=float)  # the centre itself comes first


class Search:
    """The search of one fit: `asks` gives the candidates of a pass, or None at its end, `learns` takes their totals."""

    def __init__(self, region: str, measure: str, n: float, subjects: int, center: float) -> None:
        self.key, self.n, self.subjects, self.center = (region, measure), n, subjects, center
        self.best, self.at, self.aim, self.step, self.sum = math.inf, None, None, 1.0, None

    def asks(self, step: int) -> np.ndarray | None:
        if step == 0:
            return START
        # without a likelihood at any starting point there is nothing to aim at
        if self.step > 2e-3 and self.aim is not None:
            return _allowed(self.aim + MOVES * self.step * np.maximum(np.abs(self.aim), 0.05))
        return None

    def learns(self, step: int, asked: np.ndarray, totals: np.ndarray) -> None:
        values = np.array([objective(t, self.n)[0] if np.isfinite(t).all() else math.inf for t in totals])
        i = int(np.argmin(values))
        if values[i] < self.best - 1e-9:
            self.best, self.at, self.sum = values[i], asked[i].copy(), totals[i]
        if step == 0:
            self.aim, self.step = self.at, 0.6
        elif self.at is not None:
            self.aim, self.step = _next_center(asked, values, self.at, self.step)

    def rows(self) -> list[tuple]:
        """The fit as rows of FITS."""
        if not math.isfinite(self.best):
            return [(*self.key, 0, self.subjects, False, False, False, "singular_design", *[None] * 8)]
        _, beta, cov, sigma2 = objective(self.sum, self.n)
        l11, l21, l22 = (float(x) for x in self.at)
        beta = beta + np.array([self.center] + [0.0] * (P - 1))
        slope = (l21 * l21 + l22 * l22) * sigma2
        out = []
        for term, estimate, variance in zip(TERMS, beta, np.diag(cov)):
            se = math.sqrt(max(variance, 0.0))
            p = math.erfc(abs(estimate / se) / math.sqrt(2)) if se > 0 else None
            out.append((*self.key, int(self.n), self.subjects, True, self.step < 0.05, slope == 0.0, "", sigma2, l11 * l11 * sigma2, l11 * l21 * sigma2, slope, term, float(estimate), se, p))
        return out


def _search_whole(sums: DataFrame, searches: list[dict[tuple[str, str], Search]], passes: int) -> list[list[tuple]]:
    """The rows of the fits of each value; `sums` only has regions that fit into a task each."""
    keys = {k for s in searches for k in s}

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        key, out = (rows["region"].iloc[0], rows["measure_type"].iloc[0]), []
        for arm, state in enumerate(searches):
            if key in state:
                s, own = state[key], rows[[*UNIT, *_of_arm(arm)]].set_axis([*UNIT, *SUMS], axis=1)
                own = own[own["n"] > 0]
                for step in range(passes):
                    asked = s.asks(step)
                    if asked is None:
                        break
                    s.learns(step, asked, partial_likelihood(own, asked))
                out += [(arm, *r) for r in s.rows()]
        return pd.DataFrame(out, columns=names)

    kinds = "arm int, " + FITS
    names = [c.split()[0] for c in kinds.split(", ")]
    needed = [*UNIT, *[c for arm in range(len(searches)) for c in _of_arm(arm)]]
    # a fixed number of partitions, since small sums would be put together into few tasks
    spread = sums.select("region", "measure_type", *needed).repartition(min(2 * len(keys), 1_000), "region", "measure_type")
    found: list[list[tuple]] = [[] for _ in searches]
    for r in spread.groupBy("region", "measure_type").applyInPandas(fit, kinds).collect():
        found[r.arm].append(tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r[1:]))
    return found


def _search_passes(sums: DataFrame, arm: int, state: dict[tuple[str, str], Search], passes: int) -> list[tuple]:
    """The rows of the fits of one value, by one pass over `sums` per step."""
    own = sums.select("region", "measure_type", *UNIT, *[F.col(c).alias(to) for c, to in zip(_of_arm(arm), SUMS)]).filter("n > 0")
    for step in range(passes):
        asked = {k: a for k, s in state.items() if (a := s.asks(step)) is not None}
        if not asked:
            break
        for key, totals in _evaluate(own, asked).items():
            state[key].learns(step, asked[key], totals)
    return [r for s in state.values() for r in s.rows()]


def fit_arms(observations: DataFrame, values: Mapping[str, str], passes: int = SEARCH_PASSES, whole: int = WHOLE_REGION) -> dict[str, DataFrame]:
    """`fit_regions` for several columns of values of the same rows: name of the arm -> its fits, from one pass over the rows."""
    columns = list(values.values())
    sums = materialize(subject_sums(model_rows(observations, columns), columns), "subject-sums")
    spark = observations.sparkSession
    arms = range(len(columns))
    per = sums.groupBy("region", "measure_type", "subject_id").agg(
        F.first("center").alias("center"), F.count(F.lit(1)).alias("units"), *[F.sum(c).alias(c) for i in arms for c in _of_arm(i)[:3]]
    )
    facts = [F.struct(F.sum(n).alias("n"), F.count_if(F.col(n) > 0).alias("subjects"), (F.sum(tt) - F.try_divide(F.sum(t) * F.sum(t), F.sum(n))).alias("time_ss")).alias(f"arm_{i}")
             for i in arms for n, t, tt in [_of_arm(i)[:3]]]
    overview = per.groupBy("region", "measure_type").agg(F.first("center").alias("center"), F.sum("units").alias("units"), *facts).limit(REGION_LIMIT + 1).collect()
    if len(overview) > REGION_LIMIT:
        raise ValueError(f"more than {REGION_LIMIT} regions")
    rows: list[list[tuple]] = [[] for _ in arms]
    small: list[dict[tuple[str, str], Search]] = [{} for _ in arms]
    great: list[dict[tuple[str, str], Search]] = [{} for _ in arms]
    for r in overview:
        for i in arms:
            a = r[f"arm_{i}"]
            if not a.n:
                continue
            reason = "too_few_subjects" if a.subjects < MIN_SUBJECTS else "constant_time" if a.time_ss <= 1e-12 else "too_few_rows" if a.n <= P else ""
            if reason:
                n = 0 if reason == "constant_time" else int(a.n)
                rows[i].append((r.region, r.measure_type, n, a.subjects, False, False, False, reason, *[None] * 8))
            else:
                of = small if r.units <= whole else great
                of[i][r.region, r.measure_type] = Search(r.region, r.measure_type, a.n, a.subjects, r.center)
    if any(small):
        apart = [(r.region, r.measure_type) for r in overview if r.units > whole]
        rest = sums.join(spark.createDataFrame(apart, "region string, measure_type string"), ["region", "measure_type"], "left_anti") if apart else sums
        rows = [a + b for a, b in zip(rows, _search_whole(rest, small, passes))]
    for i in arms:
        if great[i]:
            rows[i] += _search_passes(sums, i, great[i], passes)
    return {name: spark.createDataFrame(rows[i], FITS) for i, name in enumerate(values)}


def fit_regions(observations: DataFrame, passes: int = SEARCH_PASSES) -> DataFrame:
    """One row per region and term of the fixed effects: estimate, standard error, Wald p, and the fit's state.

    Regions with fewer than three subjects, or with constant time or a singular design, are not estimable and
    give one row with term null. The search over the three entries of the random effects' factor starts from a
    coarse set; each pass evaluates a grid of 27 points, aims at the minimum of a quadratic through them and narrows
    the grid; a fit converges when the grid is small.
    A slope whose variance ends at zero counts as dropped.
    """
    return fit_arms(observations, {"": "value"}, passes)[""]


def results_table(fits: DataFrame) -> DataFrame:
    """One row per region: estimate, se, p_value, q_value of the primary term, and `<...>_<family>` of the secondary ones."""
    from strataflux.functions.multiplicity import with_fdr

    families = {"": PRIMARY, "_time": SECONDARY[0], "_dx_baseline": SECONDARY[1], "_age_baseline": SECONDARY[2]}
    tested = with_fdr(fits, ["term"], testable="converged")
    head = ["region", "measure_type", "n_observations", "n_subjects", "estimable", "converged", "random_slope_dropped", "reason"]
    cells = [
        F.max(F.when(F.col("term") == term, F.col(c))).alias(f"{c}{suffix}")
        for suffix, term in families.items()
        for c in ("estimate", "se", "p_value", "q_value")
    ]
    return tested.groupBy(*head).agg(*cells)


def family_sizes(fits: DataFrame) -> DataFrame:
    """(term, n_tests, n_regions, converged_share): tests that enter the correction of each family; fits that didn't converge don't."""
    families = fits.filter(F.col("term").isin(PRIMARY, *SECONDARY))
    return families.groupBy("term").agg(
        F.count_if(F.col("converged") & F.col("p_value").isNotNull()).alias("n_tests"), F.count(F.lit(1)).alias("n_regions"),
        F.avg(F.col("converged").cast("double")).alias("converged_share"),
    )


def compare_arms(primary: DataFrame, other: DataFrame, alpha: float = 0.05) -> DataFrame:
    """(region, measure_type, estimate, estimate_other, difference, direction_changed, significance_changed, comparable) of two result tables."""
    right = other.select(F.col("region").alias("__r"), F.col("measure_type").alias("__m"), F.col("estimate").alias("estimate_other"), F.col("q_value").alias("q_other"), F.col("converged").alias("c_other"))
    joined = primary.join(right, (F.col("region") == F.col("__r")) & (F.col("measure_type") == F.col("__m")), "left")
    comparable = F.coalesce(F.col("converged") & F.col("c_other") & F.col("estimate").isNotNull() & F.col("estimate_other").isNotNull(), F.lit(False))
    changed = (F.col("q_value") <= alpha) != (F.col("q_other") <= alpha)
    return joined.select(
        "region", "measure_type", "estimate", "estimate_other", F.when(comparable, F.col("estimate") - F.col("estimate_other")).alias("difference"),
        (comparable & (F.col("estimate") * F.col("estimate_other") < 0)).alias("direction_changed"),
        (comparable & F.coalesce(changed, F.lit(False))).alias("significance_changed"), comparable.alias("comparable"),
    )
