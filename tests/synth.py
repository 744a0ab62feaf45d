"""Synthetic longitudinal measurements with known effects (test substrate)."""

from __future__ import annotations

import numpy as np

SITES = {"north": (0.0, 1.0), "south": (0.9, 1.5), "west": (-0.7, 0.7)}
REGIONS = [f"{h}-{s}" for s in ("putamen", "caudate", "thalamus") for h in ("lh", "rh")]


def cohort(subjects=60, visits=4, seed=0, slope=-0.3, patient_slope=-0.5, noise=0.15, site_effects=True):
    """Rows (subject_id, session_id, site, region, measure_type, value, time, age, sex, dx, etiv): value is location + slopes * time + batch effect."""
    rng = np.random.default_rng(seed)
    sites = list(SITES)
    rows = []
    level = {r: 4 + i for i, r in enumerate(REGIONS)}
    for s in range(subjects):
        site, age, sex, dx = sites[s % 3], float(rng.uniform(50, 80)), "FM"[rng.integers(2)], ["control", "patient"][rng.integers(2)]
        etiv = float(rng.normal(1.5e6, 1e5))
        shift, scale = SITES[site] if site_effects else (0.0, 1.0)
        for r in REGIONS:
            a, b = rng.normal(0, 0.5), rng.normal(0, 0.1)
            for v in range(visits - (s % 5 == 0)):
                t = v * 0.8 + float(rng.uniform(0, 0.2))
                mean = level[r] - 0.02 * (age - 65) + (0.2 if sex == "M" else 0) + a + (slope + b + (patient_slope if dx == "patient" else 0)) * t
                rows.append((f"s{s:03d}", f"v{v}", site, r, "volume", mean + shift + scale * float(rng.normal(0, noise)), t, age, sex, dx, etiv))
    return rows


SCHEMA = (
    "subject_id string, session_id string, site string, region string, measure_type string, value double, time_from_baseline_years double, "
    "age_baseline double, sex string, dx_baseline string, etiv_baseline double"
)

SUBCORTICAL = {"Hippocampus": 4000, "Amygdala": 1700, "Thalamus-Proper": 7500, "Caudate": 3600, "Putamen": 5000, "Lateral-Ventricle": 9000, "Inf-Lat-Vent": 500}
CORTICAL = ("entorhinal", "parahippocampal", "inferiorparietal", "precuneus", "posteriorcingulate", "middletemporal", "superiorfrontal")


def write_files(root, subjects=24, visits=3, seed=1):
    """A nested folder of .stats files, with an empty file, a truncated one, a session without files and one without a folder."""
    import pandas as pd

    rng = np.random.default_rng(seed)
    people, sessions = [], []
    for s in range(subjects):
        name, site = f"sub-{s:03d}", ["north", "south"][s % 2]
        sex, dx, age = "FM"[rng.integers(2)], ["control", "patient"][rng.integers(2)], float(rng.uniform(50, 80))
        people.append((name, site, "M", "1", 3.0, age, sex, dx, float(rng.normal(1.5e6, 1e5))))
        for v in range(visits):
            ses, t = f"ses-{v}", v * 0.9
            cause = "missing_acquisition" if (s, v) == (3, 2) else "missing_derivative" if (s, v) == (4, 2) else None
            sessions.append((name, ses, t, age + t, site, site, cause))
            if cause == "missing_acquisition":
                continue
            d = root / "derivatives" / "freesurfer" / name / ses / "stats"
            d.mkdir(parents=True)
            if cause:
                continue
            factor = lambda: 1 + (0.03 if site == "south" else 0) + 0.01 * t + float(rng.normal(0, 0.03))
            lines = ["# cvs_version 6.0.0", f"# Measure EstimatedTotalIntraCranialVol, eTIV, Volume, {rng.normal(1.5e6, 1e5):.1f}, mm^3", "# Measure lhSurfaceHoles, lhSurfaceHoles, Holes, 12, unitless",
                     "# Measure rhSurfaceHoles, rhSurfaceHoles, Holes, 14, unitless"]
            n = 0
            for side in ("Left", "Right"):
                for structure, size in SUBCORTICAL.items():
                    n += 1
                    lines.append(f"{n} {n} 100 {size * factor():.1f} {side}-{structure} 80 8 40 120 80")
            if (s, v) == (5, 1):
                lines[-1] = lines[-1][:12]
            (d / "aseg.stats").write_text("" if (s, v) == (6, 1) else "\n".join(lines) + "\n")
            for h in ("lh", "rh"):
                rows = [f"{c} 1000 900 2000 {2.6 * factor():.3f} 0.5 0.1 0.02 20 3" for c in CORTICAL]
                head = "# ColHeaders StructName NumVert SurfArea GrayVol ThickAvg ThickStd MeanCurv GausCurv FoldInd CurvInd"
                (d / f"{h}.aparc.stats").write_text("\n".join(["# cvs_version 6.0.0", head, *rows]) + "\n")
    columns = ["subject_id", "site", "scanner_manufacturer", "scanner_model", "field_strength_tesla", "age_baseline", "sex", "dx_baseline", "etiv_baseline"]
    pd.DataFrame(people, columns=columns).to_parquet(root / "subjects.parquet")
    columns = ["subject_id", "session_id", "time_from_baseline_years", "age_at_session", "site", "acquisition_site", "missing_cause"]
    pd.DataFrame(sessions, columns=columns).to_parquet(root / "sessions.parquet")
