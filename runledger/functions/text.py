"""Text and JSON Column functions (FN-01..08, FN-17..20, FN-24, FN-26).

All are native Column expressions, so they run inside whole-stage codegen and never
leave the JVM. Positions are 1-based character positions as in Spark SQL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Display limits and markers.
TRUNCATE_SUFFIX = "... (truncated)"
SUMMARY_MARKER = "\n\n[... CONTEXT SUMMARIZED FOR LENGTH ...]\n\n"
BOT_TAG = "[ADW-AGENTS]"
ISSUE_COMMANDS = ("/chore", "/bug", "/feature")
FENCE_PATTERN = r"(?s)```(?:json)?\s*\n(.*?)\n```"
# Prefixes of agent error and output texts.
ERROR_PREFIX = "Claude Code error: "
OUTPUT_PREFIX = "Claude Code output: "
# Messages ({name} marks a filled-in value).
PARSE_ERROR = "Failed to parse JSON. Text was: {text}..."
JSONL_SUMMARY = "[JSONL output with {n} messages]"
NO_COMMAND = "No command selected: {output}"
INVALID_COMMAND = "Invalid command selected: {output}"
BOTH_STREAMS = "{stderr}\nStdout: {stdout}"
EXIT_CODE_TEXT = "Command failed with exit code {code}"
BRANCH_MARKERS = ("* ", "remotes/origin/")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fill_template(template: str, values: dict) -> Column:
    """A text template with ``{name}`` slots as one ``concat`` of literals and Columns."""
    parts = re.split(r"\{(\w+)\}", template)
    cols = [F.lit(p) if i % 2 == 0 else values[p] for i, p in enumerate(parts)]
    return F.concat(*[c for i, c in enumerate(cols) if i % 2 == 1 or parts[i]])


def strip(col) -> Column:
    """Trim whitespace of any kind at both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def last_pos(col, ch: str) -> Column:
    """1-based position of the last ``ch`` in ``col``, 0 when absent."""
    c = _c(col)
    r = F.instr(F.reverse(c), ch)
    return F.when(r > 0, F.length(c) - r + 1).otherwise(F.lit(0))


def extract_json(col) -> Column:
    """FN-01: JSON text inside model output.

    First fenced block (``json`` tag optional), else the whole text; if that does not
    start with ``[`` or ``{``, cut from the first ``[`` to the last ``]`` when ``[``
    comes before any ``{``, else from the first ``{`` to the last ``}``.
    """
    c = _c(col)
    body = F.when(c.rlike(FENCE_PATTERN), strip(F.regexp_extract(c, FENCE_PATTERN, 1))).otherwise(strip(c))
    a0, a1 = F.instr(body, "["), last_pos(body, "]")
    o0, o1 = F.instr(body, "{"), last_pos(body, "}")
    clean = body.startswith("[") | body.startswith("{")
    use_array = (a0 > 0) & ((o0 == 0) | (a0 < o0))
    return (F.when(clean, body)
             .when(use_array & (a1 > 0), F.substring(body, a0, a1 - a0 + 1))
             .when(use_array, body)
             .when((o0 > 0) & (o1 > 0), F.substring(body, o0, o1 - o0 + 1))
             .otherwise(body))


def parse_typed(col, schema: str, domains: dict[str, Sequence[str]] | None = None) -> Column:
    """FN-02: parse FN-01 output with ``schema``; struct(value, error).

    ``value`` is null when the text is not JSON of that shape; ``error`` is set then
    and also when a domain check fails (``value`` is kept for inspection).

    The error carries the first 200 characters of the text; a list element outside a
    domain (e.g. status or severity) is an error too.
    """
    text = extract_json(col)
    value = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    err = F.when(value.isNull(), fill_template(PARSE_ERROR, {"text": F.substring(text, 1, 200)}))
    for field, allowed in (domains or {}).items():
        dom = F.array(*[F.lit(a) for a in allowed])
        bad = F.exists(value, lambda x: ~F.array_contains(dom, x[field]))
        err = err.when(bad, F.concat(F.lit(f"Invalid {field}. Text was: "), F.substring(text, 1, 200),
                                     F.lit("...")))
    return F.struct(value.alias("value"), err.alias("error"))


def truncate_text(col, max_length: int = 500, suffix: str = TRUNCATE_SUFFIX) -> Column:
    """FN-03: cut to ``max_length`` including the suffix, at a good break.

    Prefer the last newline among the 50 characters before the cut, then the last
    space among the 20 before it, else a hard cut. A break at position 0 does not
    count. The window start is clamped at 0.
    """
    c = _c(col)
    cut = max(max_length - len(suffix), 0)

    def last_in_window(ch: str, width: int) -> Column:
        start = max(cut - width, 0)  # 0-based start of the window
        win = F.substring(c, start + 1, cut - start)
        r = F.instr(F.reverse(win), ch)
        return F.when(r > 0, F.lit(start) + F.length(win) - r).otherwise(F.lit(-1))  # 0-based index

    nl, sp = last_in_window("\n", 50), last_in_window(" ", 20)
    return (F.when(F.length(c) <= max_length, c)
             .when(nl > 0, F.concat(F.substring(c, F.lit(1), nl), F.lit(suffix)))
             .when(sp > 0, F.concat(F.substring(c, F.lit(1), sp), F.lit(suffix)))
             .otherwise(F.concat(F.substring(c, 1, cut), F.lit(suffix))))


def summarise_jsonl(col, max_length: int = 500, suffix: str = TRUNCATE_SUFFIX) -> Column:
    """FN-04: display text of a JSONL blob, else FN-03 on the plain text.

    From the last line back: the first non-empty ``result`` of a result line, or the
    first non-empty text of an assistant line's first content item. Nothing found
    gives ``[JSONL output with N messages]`` plus the suffix.
    """
    c = _c(col)
    is_jsonl = c.startswith('{"type":') & c.contains('\n{"type":')
    lines = F.split(strip(c), "\n")

    def pick(line):
        t = F.get_json_object(line, "$.type")
        return (F.when(t == "result", F.get_json_object(line, "$.result"))
                 .when(t == "assistant", F.get_json_object(line, "$.message.content[0].text")))

    found = F.try_element_at(F.filter(F.transform(lines, pick), lambda x: F.length(x) > 0), F.lit(-1))
    blob = F.when(found.isNotNull(), truncate_text(found, max_length, suffix)).otherwise(
        F.concat(fill_template(JSONL_SUMMARY, {"n": F.size(lines).cast("string")}), F.lit(suffix)))
    return F.when(is_jsonl, blob).otherwise(truncate_text(c, max_length, suffix))


def head_tail(col, max_length: int = 8000) -> Column:
    """FN-05: first half, a marker, last half when longer than ``max_length``.

    The result is longer than ``max_length`` by the marker, as in the source.
    """
    c = _c(col)
    half = max_length // 2
    tail = F.substring(c, F.length(c) - half + 1, F.lit(half))
    return F.when(F.length(c) <= max_length, c).otherwise(
        F.concat(F.substring(c, 1, half), F.lit(SUMMARY_MARKER), tail))


# Fixed value: steps back within which the smart budget keeps a document whole.
NEAR_STEPS = 5


def budget_text(text, distance, mode: str = "smart") -> Column:
    """FN-06: context budget. smart: head/tail to 2000 when more than 5 steps back;
    summarized: always head/tail to 3000; full: unchanged."""
    t, d = _c(text), _c(distance)
    if mode == "smart":
        return F.when(d > NEAR_STEPS, head_tail(t, 2000)).otherwise(t)
    if mode == "summarized":
        return head_tail(t, 3000)
    if mode == "full":
        return t
    raise ValueError(f"unknown context mode {mode}")


def command_of(col) -> Column:
    """FN-07: the slash command at the start of the text, without the slash; null if none."""
    m = F.regexp_extract(_c(col), r"^/(\w+)", 1)
    return F.when(m != "", m)


def classify_label(col) -> Column:
    """FN-08: struct(label, error) from free text: first of /chore, /bug, /feature or 0."""
    raw = _c(col)
    out = strip(raw)
    m = F.regexp_extract(out, r"(/chore|/bug|/feature|0)", 1)
    cmd = F.when(m != "", m).otherwise(out)
    label = F.when(cmd.isin(*ISSUE_COMMANDS), cmd)
    error = (F.when(cmd == "0", fill_template(NO_COMMAND, {"output": raw}))
              .when(~cmd.isin(*ISSUE_COMMANDS), fill_template(INVALID_COMMAND, {"output": raw})))
    return F.struct(label.alias("label"), error.alias("error"))


def repo_path(url, host="https://github.com/") -> Column:
    """FN-17: drop the host prefix and every ``.git``."""
    h = F.lit(host) if isinstance(host, str) else host
    return F.replace(F.replace(_c(url), h, F.lit("")), F.lit(".git"), F.lit(""))


def parse_branch(col) -> Column:
    """FN-18: struct(branch, issue_number, run_id) from a branch listing line."""
    b = _c(col)
    for marker in BRANCH_MARKERS:
        b = F.replace(b, F.lit(marker), F.lit(""))
    num = F.regexp_extract(b, r"issue-(\d+)", 1)
    rid = F.regexp_extract(b, r"-adw-([^-]+)-", 1)
    return F.struct(b.alias("branch"), F.when(num != "", num.cast("long")).alias("issue_number"),
                    F.when(rid != "", rid).alias("run_id"))


def tag_message(run_id, agent, text, session=None) -> Column:
    """FN-19: the bot tag (``BOT_TAG``), then ``id_agent[_session]: text``."""
    who = F.concat_ws("_", _c(run_id), _c(agent), *( [_c(session)] if session is not None else []))
    return F.concat(F.lit(BOT_TAG + " "), who, F.lit(": "), _c(text))


def ensure_tag(text) -> Column:
    """FN-19: prefix the bot tag only when the text does not start with it."""
    t = _c(text)
    return F.when(t.startswith(BOT_TAG), t).otherwise(F.concat(F.lit(BOT_TAG + " "), t))


def error_text(structured, stdout, stderr, exit_code, max_length: int = 800) -> Column:
    """FN-20: error text precedence, then FN-03 at 800 characters.

    structured error; stdout only; stderr only; both (stderr first); exit code.
    """
    s, o, e = _c(structured), _c(stdout), _c(stderr)
    has_o = F.coalesce(F.length(o) > 0, F.lit(False))
    has_e = F.coalesce(F.length(e) > 0, F.lit(False))
    p = F.lit(ERROR_PREFIX)
    msg = (F.when(F.coalesce(F.length(s) > 0, F.lit(False)), F.concat(p, s))
            .when(has_o & ~has_e, F.concat(p, o))
            .when(has_e & ~has_o, F.concat(p, e))
            .when(has_o & has_e, F.concat(p, fill_template(BOTH_STREAMS, {"stderr": e, "stdout": o})))
            .otherwise(F.concat(p, fill_template(EXIT_CODE_TEXT, {"code": _c(exit_code).cast("string")}))))
    return truncate_text(msg, max_length)


def minimal_payload(df: DataFrame, cols: Sequence[str]) -> Column:
    """FN-24: a few fields as compact JSON."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def cap_text(col, n: int = 2000) -> Column:
    """FN-26: responses capped at ``n`` characters."""
    return F.substring(_c(col), 1, n)


def chunk_text(df: DataFrame, text_col: str, size: int = 5000, overlap: float = 0.0,
               keep: Sequence[str] = ()) -> DataFrame:
    """FN-26: fixed-size chunks with optional overlap, one row per chunk (whole text)."""
    step = size - int(size * overlap)
    if step <= 0:
        raise ValueError("overlap must leave a positive step")
    n = F.length(text_col)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return (df.select(*keep, F.posexplode(starts).alias("chunk_no", "_start"), text_col)
              .select(*keep, "chunk_no", F.substring(F.col(text_col), F.col("_start") + 1, F.lit(size)).alias("chunk")))
