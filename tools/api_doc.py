"""Write docs/api.md from the public functions' signatures and docstrings.

    python tools/api_doc.py
"""

from __future__ import annotations

import importlib
import inspect
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MODULES = [
    "querytrail.session",
    "querytrail.schemas",
    "querytrail.sources.topics",
    "querytrail.sources.wire",
    "querytrail.sources.tables",
    "querytrail.functions.decode",
    "querytrail.functions.encode",
    "querytrail.functions.quarantine",
    "querytrail.operators.counts",
    "querytrail.operators.pivot",
    "querytrail.operators.windows",
    "querytrail.operators.ranking",
    "querytrail.operators.filters",
    "querytrail.operators.sketches",
    "querytrail.sinks.tables",
    "querytrail.sinks.store",
    "querytrail.sinks.snapshots",
    "querytrail.sinks.batches",
    "querytrail.sinks.topic",
    "querytrail.streaming.runner",
    "querytrail.streaming.live",
    "querytrail.streaming.ranking",
    "querytrail.streaming.dedupe",
    "querytrail.streaming.supervise",
    "querytrail.plans.jobs",
    "querytrail.plans.incremental",
    "querytrail.plans.reuse",
]


def main() -> None:
    out = ["# API reference", "", "Generated by `tools/api_doc.py` from the code.", ""]
    for name in MODULES:
        mod = importlib.import_module(name)
        out += [f"## `{name}`", "", (inspect.getdoc(mod) or "").split("\n\n")[0], ""]
        for attr, obj in vars(mod).items():
            if attr.startswith("_") or getattr(obj, "__module__", None) != name:
                continue
            if not (inspect.isfunction(obj) or inspect.isclass(obj)):
                continue
            try:
                sig = str(inspect.signature(obj, eval_str=True))
            except Exception:  # annotations that do not resolve at runtime
                try:
                    sig = str(inspect.signature(obj))
                except (TypeError, ValueError):
                    sig = "(...)"
            doc = inspect.getdoc(obj) or ""
            out += [f"### `{attr}{sig}`", "", doc, ""]
    with open(os.path.join(ROOT, "docs", "api.md"), "w") as fh:
        fh.write("\n".join(out).rstrip() + "\n")


if __name__ == "__main__":
    main()
