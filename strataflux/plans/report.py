"""A self-contained HTML report from the aggregated results of a run; nothing but summaries reaches the driver."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.config import RunConfig
from strataflux.operators import confound

#: rows of one summary that the driver takes; more of them raise an error, since none is left out. All are aggregates over sites, regions or codes
SUMMARY_ROWS = 200_000
WIDTH, BAR = 520, 18
COLORS = ("#2f6f9f", "#d08a2e", "#a63d40", "#6b8e4e", "#7a5c99")


def _rows(df: DataFrame) -> list[dict]:
    rows = df.limit(SUMMARY_ROWS + 1).collect()
    if len(rows) > SUMMARY_ROWS:
        raise ValueError(f"a summary of the report has more than {SUMMARY_ROWS} rows ({', '.join(df.columns)})")
    return [r.asDict() for r in rows]


def collect_summaries(spark: SparkSession, config: RunConfig, outdir: str) -> dict[str, list[dict]]:
    read = lambda name: spark.read.parquet(f"{outdir}/{name}.parquet")
    qc, batch = read("qc_observations"), config.harmonization.batch_column
    lost = read("roster").filter("missing_cause IS NOT NULL")
    return {
        "funnel": _rows(read("accounting_funnel").orderBy("position")),
        "qc_status": _rows(qc.groupBy(F.coalesce("site", F.lit("unknown")).alias("site"), "qc_status").agg(F.count(F.lit(1)).alias("n")).orderBy("site", "qc_status")),
        "qc_flags": _rows(qc.select(F.explode("qc_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n")).orderBy("flag")),
        "missing": _rows(lost.groupBy(F.coalesce("site", F.lit("unknown")).alias("site"), "missing_cause").agg(F.count(F.lit(1)).alias("n")).orderBy("site")),
        "batches": _rows(confound.batch_sizes(qc, batch, config.harmonization.min_batch_size).orderBy("batch")),
        "crosstab": _rows(confound.time_crosstab(qc, batch).orderBy("batch")),
        "confounding": _rows(read("confounding")),
        "model": _rows(read("model_results").orderBy("region")),
        "arms": _rows(read("arm_comparison").orderBy("region")),
        "failures": _rows(read("parse_failures").groupBy("failure_code").agg(F.count(F.lit(1)).alias("n")).orderBy("failure_code")),
    }


def bars(rows: list[dict], label: str, value: str, color_by: str | None = None, line: float | None = None) -> str | None:
    """Horizontal bars; None without rows."""
    if not rows:
        return None
    top = max([r[value] or 0 for r in rows] + [line or 0]) or 1
    kinds = sorted({str(r[color_by]) for r in rows}) if color_by else [""]
    out = []
    for i, r in enumerate(rows):
        text = f"{r[label]} {r[color_by]}" if color_by else str(r[label])
        width = (r[value] or 0) / top * (WIDTH - 260)
        color = COLORS[kinds.index(str(r[color_by])) % len(COLORS)] if color_by else COLORS[0]
        y = i * BAR
        out.append(f'<text x="195" y="{y + 13}" text-anchor="end">{escape(text)}</text><rect x="200" y="{y + 2}" width="{width:.1f}" height="{BAR - 4}" fill="{color}"/>')
        out.append(f'<text x="{205 + width:.1f}" y="{y + 13}">{r[value]}</text>')
    if line:
        x = 200 + line / top * (WIDTH - 260)
        out.append(f'<line x1="{x:.1f}" x2="{x:.1f}" y1="0" y2="{len(rows) * BAR}" stroke="#444" stroke-dasharray="4"/>')
    return _svg(out, len(rows))


def intervals(rows: list[dict], alpha: float = 0.05) -> str | None:
    """Estimates with 95 % intervals, filled where the adjusted p is at most alpha."""
    own = sorted((r for r in rows if r["estimate"] is not None and r["se"]), key=lambda r: r["estimate"] / r["se"])
    if not own:
        return None
    # regions have different units, so the axis is in standard errors
    span = max(abs(r["estimate"] / r["se"]) for r in own) + 2
    x = lambda z: 360 + z / span * 150
    out = [f'<line x1="{x(0)}" x2="{x(0)}" y1="0" y2="{len(own) * BAR}" stroke="#888"/>']
    for i, r in enumerate(own):
        z, y = r["estimate"] / r["se"], i * BAR + BAR / 2
        fill = COLORS[2] if r["q_value"] is not None and r["q_value"] <= alpha else "white"
        out.append(f'<text x="195" y="{y + 4}" text-anchor="end">{escape(r["region"])}</text><line x1="{x(z - 1.96):.1f}" x2="{x(z + 1.96):.1f}" y1="{y}" y2="{y}" stroke="{COLORS[0]}"/>')
        out.append(f'<circle cx="{x(z):.1f}" cy="{y}" r="4" fill="{fill}" stroke="{COLORS[2]}"/>')
    return _svg(out, len(own))


def dumbbells(rows: list[dict]) -> str | None:
    """Both arms' estimates of every comparable region, relative to the larger one."""
    own = [r for r in rows if r["comparable"]]
    if not own:
        return None
    out = []
    for i, r in enumerate(own):
        top = max(abs(r["estimate"]), abs(r["estimate_other"])) or 1
        a, b, y = 360 + r["estimate"] / top * 140, 360 + r["estimate_other"] / top * 140, i * BAR + BAR / 2
        out.append(f'<text x="195" y="{y + 4}" text-anchor="end">{escape(r["region"])}</text><line x1="{a:.1f}" x2="{b:.1f}" y1="{y}" y2="{y}" stroke="#888"/>')
        out.append(f'<circle cx="{a:.1f}" cy="{y}" r="4" fill="{COLORS[0]}"/><circle cx="{b:.1f}" cy="{y}" r="4" fill="{COLORS[1]}"/>')
    return _svg(out, len(own))


def heatmap(rows: list[dict]) -> str | None:
    """Batches by time bins."""
    if not rows:
        return None
    bins = [k for k in rows[0] if k.startswith("bin_")]
    top = max(r[b] for r in rows for b in bins) or 1
    out = []
    for i, r in enumerate(rows):
        out.append(f'<text x="195" y="{i * BAR + 13}" text-anchor="end">{escape(str(r["batch"]))}</text>')
        for j, b in enumerate(bins):
            x = 200 + j * 70
            out.append(f'<rect x="{x}" y="{i * BAR + 1}" width="68" height="{BAR - 2}" fill="{COLORS[0]}" fill-opacity="{0.08 + 0.8 * r[b] / top:.2f}"/><text x="{x + 4}" y="{i * BAR + 13}">{r[b]}</text>')
    return _svg(out, len(rows))


def _svg(parts: list[str], rows: int) -> str:
    return f'<svg width="{WIDTH}" height="{rows * BAR + 4}" font-size="11" font-family="sans-serif">{"".join(parts)}</svg>'


def table(rows: list[dict]) -> str:
    if not rows:
        return "<p>none</p>"
    cell = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else escape(str(v))
    head = "".join(f"<th>{escape(k)}</th>" for k in rows[0])
    return f"<table><tr>{head}</tr>" + "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r.values()) + "</tr>" for r in rows) + "</table>"


def limitations(s: dict[str, list[dict]]) -> list[str]:
    """Sentences that depend on what happened in the run."""
    out = []
    for r in s["confounding"]:
        if not r["interpretable"]:
            out.append(f"Batch and time are not separable (severity {r['severity']}): harmonized slopes need caution.")
    if any(r["small"] for r in s["batches"]):
        out.append("Batches below the least size took no part in the estimation of batch effects.")
    if any(not r["converged"] for r in s["model"]):
        out.append("Some regions' models did not converge or could not be estimated; they have no adjusted p value.")
    if any(r["direction_changed"] for r in s["arms"]):
        out.append("Harmonization changed the direction of at least one primary effect.")
    return out or ["None beyond those of the methods."]


def render(s: dict[str, list[dict]], provenance: dict, errors: list[str]) -> str:
    parts = [
        ("Provenance", table([{k: v for k, v in provenance.items() if not isinstance(v, dict)}])),
        ("Loss funnel", (bars(s["funnel"], "boundary", "count") or "") + table(s["funnel"]) + "".join(f"<p><b>does not reconcile: {escape(e)}</b></p>" for e in errors)),
        ("Rejected files", table(s["failures"])),
        ("Missing sessions", bars(s["missing"], "site", "n", "missing_cause")),
        ("Quality control", (bars(s["qc_status"], "site", "n", "qc_status") or "") + (bars(s["qc_flags"], "flag", "n") or "")),
        ("Batches", bars(s["batches"], "batch", "n_subjects")),
        ("Batch and time", (heatmap(s["crosstab"]) or "") + table(s["confounding"])),
        ("Model: primary effect in standard errors", intervals(s["model"])),
        ("Model: both arms", dumbbells(s["arms"])),
        ("Limitations", "<ul>" + "".join(f"<li>{escape(x)}</li>" for x in limitations(s)) + "</ul>"),
    ]
    body = "".join(f"<h2>{escape(title)}</h2>{html}" for title, html in parts if html)
    style = "body{font:14px sans-serif;margin:2em;max-width:70em}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:2px 6px;text-align:left}"
    return f"<!doctype html><html><head><meta charset='utf-8'><title>Run report</title><style>{style}</style></head><body><h1>Run report</h1>{body}</body></html>"
