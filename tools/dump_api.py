"""Write docs/api.md: every public function of the library with its signature and the
first paragraph of its docstring, grouped by module."""

from __future__ import annotations

import importlib
import inspect
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MODULES = ["runledger.session", "runledger.functions.text", "runledger.functions.config", "runledger.functions.state",
           "runledger.functions.render", "runledger.operators.runs", "runledger.operators.config",
           "runledger.operators.reconcile", "runledger.operators.graph", "runledger.operators.security",
           "runledger.operators.quality", "runledger.operators.filters", "runledger.operators.reach", "runledger.operators.rulescan", "runledger.operators.skew",
           "runledger.sources.lines", "runledger.sources.exports", "runledger.sources.containers", "runledger.sources.logs",
           "runledger.sources.config_files", "runledger.sources.yaml_fold", "runledger.sources.documents",
           "runledger.streaming.versions", "runledger.streaming.streams"]


def main() -> None:
    out = ["# API", "", "Generated by `tools/dump_api.py`. Survey IDs appear at the start of each summary.", ""]
    for name in MODULES:
        mod = importlib.import_module(name)
        out += [f"## `{name}`", "", (inspect.getdoc(mod) or "").split("\n\n")[0], ""]
        for fname, fn in inspect.getmembers(mod, inspect.isfunction):
            if fname.startswith("_") or fn.__module__ != name:
                continue
            doc = (inspect.getdoc(fn) or "").split("\n\n")[0].replace("\n", " ")
            out.append(f"- `{fname}{inspect.signature(fn)}`: {doc}")
        out.append("")
    with open(os.path.join(ROOT, "docs", "api.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
