"""Block YAML to JSON text by Column functions: a fold over a document's lines.

The fold's state is the JSON written so far, the stack of open mappings and lists with their
indentation, and what is waiting for a value. Read: nested mappings and lists (also ``- key: value``
and lists at their key's indentation), flow collections on one line, quoted and plain scalars by the
YAML 1.1 rules (dates stay text), ``|`` and ``>`` block text, comments, one leading ``---``.
Everything else (anchors, aliases, tags, merge and complex keys, scalars and flow collections over
several lines, several documents, other number notations) is refused with a reason, never misread.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOUBLE = r'"(?:[^"\\]|\\.)*"'
_SINGLE = r"'(?:[^']|'')*'"
_JSON_STRING = r'"(?:[^"\\]|\\["\\/bnrtf]|\\u[0-9a-fA-F]{4})*"'
_KEY = rf"^({_DOUBLE}|{_SINGLE}|[^\s\"'\[\]{{}}#&*!|>%@`,?:](?:[^:#]|:(?=\S)|(?<=\S)#)*?)\s*:(?:\s+(.*))?$"
_FLOW_TOKEN = rf"{_DOUBLE}|{_SINGLE}|[\[\]{{}},]|:(?=[\s,\]}}]|$)|[^\s\[\]{{}},\"':](?:[^\[\]{{}},:]|:(?=[^\s,\]}}]))*"
# Plain scalars of YAML 1.1.
_NULL = r"^(~|null|Null|NULL)?$"
_TRUE, _FALSE = r"^(yes|Yes|YES|true|True|TRUE|on|On|ON)$", r"^(no|No|NO|false|False|FALSE|off|Off|OFF)$"
_INT, _FLOAT = r"^[-+]?(0|[1-9][0-9]*)$", r"^[-+]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][-+][0-9]+)?$"
_OTHER_NUMBER = r"^[-+]?(0[0-7_]+|0b[01_]+|0x[0-9a-fA-F_]+|[0-9][0-9_]*_[0-9_]*(\.[0-9_]*)?|[0-9][0-9_]*(:[0-5]?[0-9])+(\.[0-9_]*)?|\.(inf|Inf|INF)|\.(nan|NaN|NAN))$"

NONE = -2  # no key or dash waits for a value; no block text is open
_STATE = ("struct<out:string,st:array<struct<i:int,k:string>>,pend:int,kind:string,err:string,bi:int,style:string,text:array<string>>")


def _quoted(c: Column) -> Column:
    arr = F.to_json(F.array(c))
    return F.substring(arr, F.lit(2), F.length(arr) - 2)


def _plain(t: Column) -> Column:
    """A plain scalar as JSON; null where it is refused."""
    sign = F.regexp_replace(t, r"^\+", "")
    point = F.regexp_replace(F.regexp_replace(sign, r"^(-?)\.", "$10."), r"\.(?=[eE]|$)", ".0")
    number = F.regexp_replace(point, r"^(-?)0+(?=[0-9])", "$1")
    refused = t.rlike(_OTHER_NUMBER) | t.rlike(r"^[&*!%@`|>?\"'\[\]{},]") | t.rlike(r":(\s|$)") | t.rlike(r"^-(\s|$)")
    return (F.when(t.rlike(_NULL), F.lit("null")).when(t.rlike(_TRUE), F.lit("true")).when(t.rlike(_FALSE), F.lit("false"))
             .when(t.rlike(_INT), sign).when(t.rlike(_FLOAT), number).when(refused, F.lit(None)).otherwise(_quoted(t)))


def _text_of(t: Column) -> Column:
    """A quoted scalar as JSON; null where it is refused."""
    return (F.when(t.rlike(rf"^{_JSON_STRING}$"), t)
             .when(t.rlike(rf"^{_SINGLE}$"), _quoted(F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit("''"), F.lit("'")))))


def _flow(v: Column) -> Column:
    """A flow collection as JSON: punctuation stays, what stands before a colon is a key."""
    tokens = F.transform(F.regexp_extract_all(v, F.lit(f"({_FLOW_TOKEN})"), F.lit(1)), lambda x: F.trim(x))
    quoted = lambda t: t.rlike("^[\"']")
    scalar = lambda t: F.when(quoted(t), _text_of(t)).otherwise(_plain(t))
    key = lambda t: F.when(quoted(t), _text_of(t)).otherwise(_quoted(t))
    after = F.concat(F.slice(tokens, F.lit(2), F.size(tokens)), F.array(F.lit("")))
    parts = F.zip_with(tokens, after, lambda t, n: F.when(t.rlike(r"^[\[\]{},:]$"), t).when(n == ":", key(t)).otherwise(scalar(t)))
    whole = (F.trim(F.regexp_replace(v, _FLOW_TOKEN, "")) == "") & ~F.exists(parts, lambda x: x.isNull())
    return F.when(whole, F.array_join(parts, ""))


def _value(v: Column) -> Column:
    """(json, style, bad) of what follows a key or dash; json null and not bad: nothing follows."""
    quoted = F.regexp_extract(v, rf"^({_DOUBLE}|{_SINGLE})\s*(?:#.*)?$", 1)
    style = F.regexp_extract(v, r"^([|>][+-]?)\s*(?:#.*)?$", 1)
    bare = F.trim(F.regexp_replace(v, r"\s+#.*$", ""))
    empty = (v == "") | v.startswith("#")
    flow = v.rlike(r"^[\[{]")
    json = F.when(empty | (style != ""), F.lit(None)).when(quoted != "", _text_of(quoted)).when(flow, _flow(bare)).otherwise(_plain(bare))
    return F.struct(json.alias("json"), F.when(style != "", style).alias("style"), (~empty & (style == "") & json.isNull()).alias("bad"))


def _tokens(line: Column) -> Column:
    """The dashes of a line and the key or scalar after them: (i, kind, key, v), i being the column."""
    body = F.ltrim(line)
    indent = F.length(line) - F.length(body)
    dashes = F.regexp_extract(body, r"^((?:-(?: +|$))*)", 1)
    rest = F.rtrim(F.substring(body, F.length(dashes) + 1, F.length(body)))
    none = F.struct(F.lit(None).cast("string").alias("json"), F.lit(None).cast("string").alias("style"), F.lit(False).alias("bad"))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(dashes), F.lit(1))), lambda p: F.substring(dashes, p, F.lit(1)) == "-")
    marks = F.transform(at, lambda p: F.struct((indent + p - 1).alias("i"), F.lit("d").alias("kind"), F.lit(None).cast("string").alias("key"), none.alias("v")))
    name = F.regexp_extract(rest, _KEY, 1)
    is_key = rest.rlike(_KEY)
    key = F.when(name == "<<", F.lit(None)).when(name.rlike("^[\"']"), _text_of(name)).otherwise(_quoted(name))
    after = F.trim(F.regexp_extract(rest, _KEY, 2))
    last = F.struct((indent + F.length(dashes)).alias("i"), F.when(is_key, "k").otherwise("v").alias("kind"),
                    F.when(is_key, key).alias("key"), F.when(is_key, _value(after)).otherwise(_value(rest)).alias("v"))
    return F.when((rest == "") | rest.startswith("#"), marks).otherwise(F.concat(marks, F.array(last)))


def parsed_lines(text: Column) -> Column:
    """Every line with what the fold asks about it; select it before :func:`yaml_json`."""
    lines = F.split(F.regexp_replace(text, "\r\n", "\n"), "\n")
    return F.transform(lines, lambda x: F.struct(
        x.alias("raw"), (F.trim(x) == "").alias("blank"), (F.length(x) - F.length(F.ltrim(x))).alias("i"),
        F.ltrim(x).startswith("#").alias("comment"), x.rlike(r"^---\s*$").alias("start"),
        (x.rlike(r"^ *\t") | x.rlike(r"^(---|\.\.\.|%)")).alias("odd"), _tokens(x).alias("tokens")))


def _block(s: Column) -> Column:
    """The open block text of a state as JSON; null where its indentation is refused."""
    filled = F.filter(s["text"], lambda x: F.trim(x) != "")
    margin = F.length(F.get(filled, F.lit(0))) - F.length(F.ltrim(F.get(filled, F.lit(0))))
    cut = F.array_join(F.transform(s["text"], lambda x: F.substring(x, F.coalesce(margin, F.lit(0)) + 1, F.length(x))), "\n")
    short = F.exists(filled, lambda x: F.length(x) - F.length(F.ltrim(x)) < margin)
    deeper = F.exists(filled, lambda x: F.length(x) - F.length(F.ltrim(x)) > margin)
    body = F.regexp_replace(cut, r"\n*$", "")
    folded = F.regexp_replace(F.regexp_replace(body, r"(?<!\n)\n(?!\n)", " "), r"\n(\n+)", "$1")
    shown = F.when(s["style"].startswith(">"), folded).otherwise(body)
    end = F.when(s["style"].endswith("-") | (body == ""), F.lit("")).otherwise(F.lit("\n"))
    refused = short | (s["style"].startswith(">") & deeper) | s["style"].endswith("+")
    return F.when(~F.coalesce(refused, F.lit(False)), _quoted(F.concat(shown, end)))


def _state(out, st, pend, kind, err, bi, style, text) -> Column:
    return F.struct(out.alias("out"), st.alias("st"), pend.alias("pend"), kind.alias("kind"), err.alias("err"), bi.alias("bi"),
                    style.alias("style"), text.alias("text")).cast(_STATE)


def _closers(popped: Column) -> Column:
    return F.array_join(F.transform(F.reverse(popped), lambda c: F.when(c["k"] == "l", "]").otherwise("}")), "")


def _token(s: Column, t: Column) -> Column:
    """The state after a dash, key or scalar."""
    dash = t["kind"] == "d"
    opens = (s["pend"] > NONE) & ((t["i"] > s["pend"]) | (dash & (t["i"] == s["pend"]) & (s["kind"] == "k")))
    stays = lambda c: (c["i"] < t["i"]) | ((c["i"] == t["i"]) & ((c["k"] == "m") | dash))
    kept = F.filter(s["st"], stays)
    top = F.get(kept, F.size(kept) - 1)
    fits = F.coalesce((top["i"] == t["i"]) & ((top["k"] == "l") == dash) & (t["kind"] != "v"), F.lit(False))
    scalar = t["kind"] == "v"
    box = F.struct(t["i"].alias("i"), F.when(dash, "l").otherwise("m").alias("k"))
    st = F.when(opens, F.when(scalar, s["st"]).otherwise(F.concat(s["st"], F.array(box)))).otherwise(kept)
    lead = F.when(opens, F.when(scalar, "").when(dash, "[").otherwise("{")).otherwise(
        F.concat(F.when(s["pend"] > NONE, "null").otherwise(""), _closers(F.filter(s["st"], lambda c: ~stays(c))), F.lit(",")))
    entry = F.when(t["kind"] == "k", F.concat(t["key"], F.lit(":"))).otherwise(F.lit(""))
    waits = dash | (t["v"]["json"].isNull() & t["v"]["style"].isNull())
    block = ~dash & t["v"]["style"].isNotNull()
    bad = (~opens & ~fits) | t["v"]["bad"] | ((t["kind"] == "k") & t["key"].isNull())
    nothing = F.lit(NONE)
    return _state(F.concat(s["out"], lead, F.coalesce(entry, F.lit("")), F.when(dash, "").otherwise(F.coalesce(t["v"]["json"], F.lit("")))),
                  st, F.when(waits, t["i"]).otherwise(nothing), F.when(dash, "d").otherwise("k"), F.when(bad, "not read").otherwise(s["err"]),
                  F.when(block, F.when(scalar, s["pend"]).otherwise(t["i"])).otherwise(nothing), t["v"]["style"], F.array().cast("array<string>"))


def _flushed(s: Column) -> Column:
    """The state with its block text, if any, written."""
    json = _block(s)
    return F.when(s["bi"] == NONE, s).otherwise(_state(
        F.concat(s["out"], F.coalesce(json, F.lit(""))), s["st"], F.lit(NONE), s["kind"], F.when(json.isNull(), "not read").otherwise(s["err"]),
        F.lit(NONE), F.lit(None), F.array().cast("array<string>")))


def _line(s: Column, x: Column) -> Column:
    in_block = (s["bi"] > NONE) & (x["blank"] | (x["i"] > s["bi"]))
    more = _state(s["out"], s["st"], s["pend"], s["kind"], s["err"], s["bi"], s["style"], F.concat(s["text"], F.array(x["raw"])))
    refused = _state(s["out"], s["st"], s["pend"], s["kind"], F.lit("not read"), s["bi"], s["style"], s["text"])
    first = x["start"] & (s["out"] == "") & (F.size(s["st"]) == 0)
    return (F.when(s["err"].isNotNull(), s).when(in_block, more).when(x["blank"] | x["comment"] | first, _flushed(s)).when(x["odd"], refused)
             .otherwise(F.aggregate(x["tokens"], _flushed(s), _token)))


def yaml_json(lines: Column) -> Column:
    """The JSON text of :func:`parsed_lines` of a document: ``{}`` for one without content, null where it
    is refused."""
    start = _state(F.lit(""), F.array().cast("array<struct<i:int,k:string>>"), F.lit(-1), F.lit("r"), F.lit(None), F.lit(NONE), F.lit(None),
                   F.array().cast("array<string>"))

    def finish(s: Column) -> Column:
        json = F.concat(s["out"], F.when(s["pend"] > NONE, "null").otherwise(""), _closers(s["st"]))
        return F.when((s["out"] == "") & s["err"].isNull(), F.lit("{}")).when(s["err"].isNull() & F.try_parse_json(json).isNotNull(), json)

    return F.aggregate(F.aggregate(lines, start, _line, lambda s: F.array(_flushed(s))), F.lit("").cast("string"), lambda _, s: finish(s))
