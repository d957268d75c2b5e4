"""The run report as one HTML page: records go in as JSON, a few lines of script lay them out."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable

from pyspark.sql import DataFrame

from quarrylit.sources.stages import save_text

_PAGE = """<!doctype html>
<html lang="en"><head><meta charset="utf-8"><title>Run report</title>
<style>body{font:15px sans-serif;margin:2em;max-width:70em}article{border-top:1px solid #999;padding:1em 0}img{max-width:30em}td{padding:0 1em 0 0}</style>
</head><body><h1>Run report</h1><p id="head"></p><main></main>
<script id="data" type="application/json">@@DATA@@</script>
<script>
const data = JSON.parse(document.getElementById("data").textContent);
document.getElementById("head").textContent = Object.entries(data.header).map(([k, v]) => k + ": " + v).join(" | ");
for (const paper of data.papers) {
  const box = document.createElement("article");
  for (const [key, value] of Object.entries(paper)) {
    if (value === null || value === "") continue;
    const row = document.createElement(key === "image" ? "img" : "p");
    if (key === "image") row.src = value; else row.textContent = key + ": " + (typeof value === "object" ? JSON.stringify(value) : value);
    box.append(row);
  }
  document.querySelector("main").append(box);
}
</script></body></html>
"""


def render(header: dict, papers: list[dict], *, image: Callable[[str], bytes] | None = None) -> str:
    """The page; with a reader of image bytes, images are part of it instead of links."""
    if image:
        papers = [{k: "data:image/png;base64," + base64.b64encode(image(v)).decode() if k == "image" and v else v for k, v in p.items()} for p in papers]
    # a closing tag inside a text must not end the script
    data = json.dumps({"header": header, "papers": papers}, ensure_ascii=False, default=str).replace("</", "<\\/")
    return _PAGE.replace("@@DATA@@", data)


def write(header: dict, papers: DataFrame, path: str, **options) -> None:
    """Writes the page of one run, whose papers (a few hundred rows at most: a page is for readers) come to the driver in their order."""
    save_text(papers.sparkSession, path, render(header, [r.asDict(recursive=True) for r in papers.toLocalIterator()], **options))
