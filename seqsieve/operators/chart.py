"""Data and drawing of the stacked bar chart of reads by category."""

from __future__ import annotations

from dataclasses import dataclass
from html import escape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse_yes

#: Categories in drawing order with their colours, and the bounds of error rates.
CATEGORIES = [("adapter", "magenta"), ("unmapped", "grey97"), ("unexpected/contaminant", "red"), ("control", "goldenrod1"), ("expected species", "green")]
COLOURS = {"magenta": "#ff00ff", "grey97": "#f7f7f7", "red": "#ff0000", "goldenrod1": "#ffc125", "green": "#00ff00"}
LEAST_RATE, MOST_RATE = 0.25, 1.5


def plot_data(alignment_summary: DataFrame, summary: DataFrame) -> DataFrame:
    """A row for each bar. alignment_summary: id, genome, expected, control (yes/no/null), assigned, assigned error rate
    in the order of its rows, told by column place; summary: id, sequences, sampled, adapter. The result is one small
    table, so its numbering is one task's work."""
    ids = alignment_summary.groupBy("id").agg(F.min("place").alias("first"))
    ids = ids.select(F.col("id").alias("user_id"), F.row_number().over(Window.orderBy("first")).alias("id"))
    flags = alignment_summary.withColumnsRenamed({"id": "user_id", "genome": "reference", "assigned": "count", "assigned error rate": "error_rate"})
    category = F.when(parse_yes(F.col("control")), "control").when(parse_yes(F.col("expected")), "expected species")
    category = F.when(F.col("expected").isNull(), "unmapped").otherwise(F.coalesce(category, F.lit("unexpected/contaminant")))
    bars = flags.filter("count > 0").select("user_id", "reference", F.col("count").cast("double").alias("count"), "error_rate", category.alias("category"), F.lit("genome").alias("type"))
    adapters = summary.select(
        F.col("id").alias("user_id"), F.lit("adapter").alias("reference"), F.col("adapter").cast("double").alias("count"), F.lit(LEAST_RATE).alias("error_rate"), F.lit("adapter").alias("category"), F.lit("adapter").alias("type")
    )
    totals = summary.select(F.col("id").alias("user_id"), "sequences", "sampled")
    rows = bars.unionByName(adapters).join(totals, "user_id", "left").join(ids, "user_id", "left")
    scaled = F.when(F.col("sampled") == 0, 0.0).otherwise(F.col("count") / F.when(F.col("sampled") != 0, F.col("sampled")) * F.col("sequences") / 1e6)
    bounded = F.when(F.col("category") == "unmapped", LEAST_RATE).otherwise(F.greatest(F.least("error_rate", F.lit(MOST_RATE)), F.lit(LEAST_RATE)))
    place = F.element_at(F.create_map(*(x for n, (c, _) in enumerate(CATEGORIES) for x in (F.lit(c), F.lit(n)))), F.col("category"))
    order = Window.orderBy("id", "type", place, "count", "reference")
    return rows.withColumns({"scaled_count": scaled, "bounded_error_rate": bounded, "bar_width": F.when(F.col("type") == "adapter", 0.5).otherwise(1.0)}).select(
        "id", "user_id", "reference", "count", "error_rate", "category", "type", "scaled_count", "bounded_error_rate", F.row_number().over(order).alias("group"), "bar_width"
    )


@dataclass
class Drawing:
    """Boxes (x, y, width, height, fill, opacity, title) and texts (x, y, text, right: x is the text's end), from the upper left."""

    width: int
    height: int
    boxes: list[tuple[float, float, float, float, str, float, str]]
    texts: list[tuple[float, float, str, bool]]


def draw(plot: DataFrame) -> Drawing:
    """The chart of plot_data(), a bar for each row. The driver draws it from its few rows."""
    rows = plot.orderBy("group").collect()
    names = list(dict.fromkeys(r["user_id"] for r in rows))
    width, row, left, top = 960, 56, 160, 24
    sums: dict[tuple, float] = {}
    for r in rows:
        sums[r["user_id"], r["type"]] = sums.get((r["user_id"], r["type"]), 0.0) + (r["scaled_count"] or 0.0)
    scale = (width - left - 40) / (1.05 * max(sums.values(), default=0.0) or 1.0)
    fills = {c: COLOURS[n] for c, n in CATEGORIES}
    rates = [r["bounded_error_rate"] for r in rows if r["bounded_error_rate"] is not None]
    low, high = min(rates, default=0.0), max(rates, default=1.0)
    boxes, at = [], dict.fromkeys(sums, 0.0)
    for r in rows:
        key, length = (r["user_id"], r["type"]), (r["scaled_count"] or 0.0) * scale
        rate = r["bounded_error_rate"] if r["bounded_error_rate"] is not None else high
        small = r["type"] == "adapter"
        y = top + names.index(r["user_id"]) * row + (28 if small else 0)
        boxes.append((left + at[key], y, length, 12 if small else 24, fills[r["category"]], 1.0 - 0.9 * (rate - low) / ((high - low) or 1.0), f"{r['reference']}: {r['category']}"))
        at[key] += length
    texts = [(left - 8, top + i * row + 16, str(n), True) for i, n in enumerate(names)]
    legend_y = top + len(names) * row + 12
    for i, (c, _) in enumerate(reversed(CATEGORIES)):
        boxes.append((left + 150 * i, legend_y, 12, 12, fills[c], 1.0, ""))
        texts.append((left + 150 * i + 18, legend_y + 11, c, False))
    return Drawing(width, legend_y + 32, boxes, texts)


def bar_chart(plot: DataFrame) -> str:
    """The chart as SVG text."""
    d = draw(plot)
    named = lambda title: f"<title>{escape(title)}</title>" if title else ""
    boxes = [
        f'<rect x="{x:.2f}" y="{y}" width="{w:.2f}" height="{h}" fill="{fill}" fill-opacity="{alpha:.3f}" stroke="#4d4d4d">{named(title)}</rect>' for x, y, w, h, fill, alpha, title in d.boxes
    ]
    texts = [f'<text x="{x}" y="{y}" text-anchor="{"end" if right else "start"}">{escape(text)}</text>' for x, y, text, right in d.texts]
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{d.width}" height="{d.height}" font-family="sans-serif" font-size="12">{"".join(boxes + texts)}</svg>'


def bar_chart_pdf(plot: DataFrame) -> bytes:
    """The chart as a PDF file of one page. Its font has one width for all characters, so that names end where they
    should; a character that Windows-1252 lacks is a question mark."""
    d = draw(plot)
    size, page = 10, []
    for x, y, w, h, fill, alpha, _ in d.boxes:
        shade = [1 - alpha * (1 - int(fill[i : i + 2], 16) / 255) for i in (1, 3, 5)]  # on white paper
        page.append(b"%.3f %.3f %.3f rg 0.3 G %.2f %.2f %.2f %.2f re B" % (*shade, x, d.height - y - h, w, h))
    for x, y, text, right in d.texts:
        shown = text.encode("cp1252", "replace")
        begin = x - 0.6 * size * len(shown) if right else x
        for c in (b"\\", b"(", b")"):
            shown = shown.replace(c, b"\\" + c)
        page.append(b"BT 0 g /F %d Tf %.2f %.2f Td (%s) Tj ET" % (size, begin, d.height - y, shown.replace(b"\n", b" ").replace(b"\r", b" ")))
    content = b"\n".join(page)
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %d %d] /Contents 4 0 R /Resources << /Font << /F 5 0 R >> >> >>" % (d.width, d.height),
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(content), content),
        b"<< /Type /Font /Subtype /Type1 /BaseFont /Courier /Encoding /WinAnsiEncoding >>",
    ]
    out, places = b"%PDF-1.4\n", []
    for n, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    table = b"".join(b"%010d 00000 n \n" % p for p in places)
    size_of = len(objects) + 1
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (size_of, table, size_of, len(out))
