"""Raw entries parsed into structured ones by plug-ins, one for each kind of dictionary.

A parser is a function of headword and markup that returns an entry as plain dicts in the shape of
ENTRY. Entries are parsed in Arrow batches; what a parser can't read, and what breaks the contract,
comes out as a message beside the entries, and the coverage of each dictionary is an aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.functions.html import tokens

# Closed vocabularies of the model.
SENSE_KINDS = ("sense", "phrase", "phrasal_verb", "derivative", "collocation", "note")
EXAMPLE_KINDS = ("example", "collocation", "quotation")
REGIONS = ("", "uk", "us")
STUBS = ("xref", "popup", "inflection", "variant", "derivative", "index", "image", "empty")
COVERS = ("definitions", "pronunciation", "etymology", "collocations", "notes")

_S, _A = T.StringType(), T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PRON = _struct(ipa=_S, region=_S, audio=_S, note=_S)
EXAMPLE = _struct(text=_S, text_zh=_S, kind=_S, source=_S, date=_S, labels=_A)
SENSE = _struct(kind=_S, pos=_S, number=_S, phrase=_S, labels=_A, definition=_S, definition_zh=_S, examples=T.ArrayType(EXAMPLE))
ENTRY = _struct(headword=_S, homograph=_S, pos=_A, prons=T.ArrayType(PRON), senses=T.ArrayType(SENSE), etymology=_S, forms=_A, stub=_S, part_of=_S, extra=T.MapType(_S, _S))
PARSED = T.StructType([T.StructField("entry_id", T.LongType()), T.StructField("dict_id", T.LongType()), T.StructField("entry", ENTRY), T.StructField("problems", _A)])


def filled(kind: T.StructType, given: dict) -> dict:
    """given with what it doesn't say empty."""
    out = {}
    for f in kind.fields:
        v = given.get(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out[f.name] = [filled(f.dataType.elementType, x) for x in v or []]
        else:
            out[f.name] = v if v is not None else ([] if isinstance(f.dataType, T.ArrayType) else {} if isinstance(f.dataType, T.MapType) else "")
    return out


@dataclass(frozen=True)
class Parser:
    key: str
    covers: str
    least: float
    parse: Callable[[str, str], dict]


PARSERS: dict[str, Parser] = {}


def parser(key: str, covers: str, least: float = 0.99) -> Callable:
    """Registers a parser under a key."""
    if covers not in COVERS:
        raise ValueError(f"unknown coverage {covers!r}")

    def add(f: Callable[[str, str], dict]) -> Callable[[str, str], dict]:
        if key in PARSERS:
            raise ValueError(f"two parsers for {key!r}")
        PARSERS[key] = Parser(key, covers, least, f)
        return f

    return add


def covered(entry: dict, kind: str) -> bool:
    senses = entry["senses"]
    return {
        "definitions": any(s["definition"] or s["definition_zh"] for s in senses), "pronunciation": bool(entry["prons"]), "etymology": bool(entry["etymology"]),
        "collocations": any(x["kind"] == "collocation" for s in senses for x in s["examples"]), "notes": any(s["definition"] or s["examples"] for s in senses),
    }[kind]


def _strings(value: object, where: str) -> Iterator[tuple[str, str]]:
    if isinstance(value, str):
        yield where, value
    elif isinstance(value, dict):
        for k, v in value.items():
            yield from _strings(v, f"{where}.{k}" if where else k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from _strings(v, f"{where}[{i}]")


_MARKUP = re.compile(r"</?(?:a|b|br|div|em|font|h[1-6]|i|img|li|ol|p|span|strong|sub|sup|table|td|tr|u|ul)(?:\s[^<>]*)?/?>", re.I)


def problems(entry: dict, covers: str = "") -> list[str]:
    """What breaks the contract of the model."""
    out = [f"{w}: not a clean string: {v[:60]!r}" for w, v in _strings({k: v for k, v in entry.items() if k != "extra"}, "") if v != " ".join(v.split()) or _MARKUP.search(v)]
    rules = [
        (not entry["headword"], "empty headword"),
        (entry["stub"] and entry["stub"] not in STUBS, f"stub reason {entry['stub']!r}"),
        (entry["part_of"] and entry["stub"] != "popup", "part_of on a record that is no popup"),
        (entry["stub"] == "popup" and not entry["part_of"], "popup without part_of"),
        (covers and entry["stub"] and covered(entry, covers), f"stub ({entry['stub']}) that is covered for {covers}"),
    ]
    for p in entry["prons"]:
        rules += [(not p["ipa"] and not p["audio"], "pronunciation without sound or signs"), (p["region"] not in REGIONS, f"region {p['region']!r}")]
    for i, s in enumerate(entry["senses"]):
        rules += [
            (s["kind"] not in SENSE_KINDS, f"sense[{i}]: kind {s['kind']!r}"),
            (s["kind"] not in ("sense", "note", "collocation") and not s["phrase"], f"sense[{i}]: kind {s['kind']} needs a phrase"),
            (not (s["definition"] or s["definition_zh"] or s["examples"] or s["phrase"]), f"sense[{i}]: empty"),
        ]
        for j, x in enumerate(s["examples"]):
            rules += [(not (x["text"] or x["text_zh"]), f"sense[{i}].example[{j}]: empty"), (x["kind"] not in EXAMPLE_KINDS, f"sense[{i}].example[{j}]: kind {x['kind']!r}")]
    return out + [message for broken, message in rules if broken]


def parse_entries(entries: DataFrame, parser_of: Column) -> DataFrame:
    """PARSED rows of entries (id, dict_id, headword, body); parser_of names the parser of a row.

    An entry whose parser raises has no entry and a message; a null body or headword is read as empty.
    """
    rows = entries.select(F.col("id").alias("entry_id"), "dict_id", "headword", "body", parser_of.alias("key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, d, headword, body, key in zip(pdf.entry_id, pdf.dict_id, pdf.headword, pdf.body, pdf.key):
                try:
                    own = PARSERS[key]
                    entry = filled(ENTRY, own.parse(headword or "", body or ""))
                    out.append((i, d, entry, problems(entry, own.covers)))
                except Exception as e:  # one bad entry is a message, not the end of the job
                    out.append((i, d, None, [f"{type(e).__name__}: {e}"]))
            yield pd.DataFrame(out, columns=PARSED.fieldNames())

    return rows.mapInPandas(run, PARSED)


def tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """s_entry, s_pron, s_sense and s_example of the entries without problems; order is kept as ord."""
    good = parsed.where("entry is not null and size(problems) = 0")
    entry = good.select("entry_id", "dict_id", *(F.col(f"entry.{c}").alias(c) for c in ("headword", "homograph", "pos", "etymology", "forms", "extra", "stub", "part_of")))
    pron = good.select("entry_id", F.posexplode("entry.prons").alias("ord", "p")).select("entry_id", "ord", "p.*")
    senses = good.select("entry_id", "dict_id", F.posexplode("entry.senses").alias("ord", "s"))
    sense = senses.select("entry_id", "dict_id", "ord", *(F.col(f"s.{f.name}").alias(f.name) for f in SENSE.fields if f.name != "examples"))
    example = senses.select("entry_id", F.col("ord").alias("sense_ord"), F.posexplode("s.examples").alias("ord", "x")).select("entry_id", "sense_ord", "ord", "x.*")
    return {"s_entry": entry, "s_pron": pron, "s_sense": sense, "s_example": example}


def coverage(parsed: DataFrame, covers: str) -> DataFrame:
    """(dict_id, entries, stubs, covered, failed): what came of each dictionary's entries."""
    has = {
        "definitions": F.exists("entry.senses", lambda s: (s["definition"] != "") | (s["definition_zh"] != "")), "pronunciation": F.size("entry.prons") > 0, "etymology": F.col("entry.etymology") != "",
        "collocations": F.exists("entry.senses", lambda s: F.exists(s["examples"], lambda x: x["kind"] == "collocation")), "notes": F.exists("entry.senses", lambda s: (s["definition"] != "") | (F.size(s["examples"]) > 0)),
    }[covers]
    ok = F.col("entry").isNotNull() & (F.size("problems") == 0)
    stub = ok & (F.col("entry.stub") != "")
    return parsed.groupBy("dict_id").agg(F.count("*").alias("entries"), F.count_if(stub).alias("stubs"), F.count_if(ok & ~stub & has).alias("covered"), F.count_if(~ok).alias("failed"))


def failures(report: DataFrame, least: float) -> DataFrame:
    """Dictionaries that must not be published: any failed entry, or coverage of the others below least, unrounded."""
    content = F.col("entries") - F.col("stubs")
    return report.where((F.col("failed") > 0) | ((content > 0) & (F.col("covered") < F.lit(least) * content)))


# Demonstration parsers for invented markup.


def _by_class(markup: str) -> list[tuple[str, str]]:
    """(class, text) of the innermost elements with a class or of a kind of their own, in order."""
    out, stack = [], []
    for kind, value, attributes in tokens(markup):
        if kind == "open":
            stack.append((value, attributes.get("class", value)))
        elif kind == "close":
            while stack and stack.pop()[0] != value:
                pass
        elif value.strip():
            out.append((stack[-1][1] if stack else "", " ".join(value.split())))
    return out


@parser("plain", "definitions")
def plain(headword: str, markup: str) -> dict:
    """A headword and paragraphs, each a sense; a record without any is a stub."""
    parts = _by_class(markup)
    word = next((t for c, t in parts if c == "hw"), " ".join(headword.split()))
    senses = [{"kind": "sense", "number": str(i), "definition": t} for i, t in enumerate((t for c, t in parts if c == "p"), 1)]
    return {"headword": word, "senses": senses, "stub": "" if senses else "empty"}


@parser("bilingual", "definitions")
def bilingual(headword: str, markup: str) -> dict:
    """Numbered senses with parts of speech, Chinese, examples and sound, told apart by class."""
    out: dict = {"headword": " ".join(headword.split()), "pos": [], "prons": [], "senses": []}
    pos = ""
    for c, t in _by_class(markup):
        if c == "hw":
            out["headword"] = t
        elif c == "pos":
            pos = t
            out["pos"] = list(dict.fromkeys([*out["pos"], t]))
        elif c in ("uk", "us"):
            out["prons"].append({"ipa": t.strip("/[] "), "region": c})
        elif c == "def":
            out["senses"].append({"kind": "sense", "pos": pos, "number": str(len(out["senses"]) + 1), "definition": t})
        elif c == "zh" and out["senses"]:
            last = out["senses"][-1]
            if last.get("examples"):
                last["examples"][-1]["text_zh"] = t
            else:
                last["definition_zh"] = t
        elif c == "ex" and out["senses"]:
            out["senses"][-1].setdefault("examples", []).append({"text": t, "kind": "example"})
        elif c == "see":
            out["stub"] = "xref"
    return out


@parser("origins", "etymology")
def origins(headword: str, markup: str) -> dict:
    """One text on where the word comes from, homographs one after the other."""
    text = " ".join(t for c, t in _by_class(markup) if c in ("p", "prose"))
    return {"headword": " ".join(headword.split()), "etymology": text, "stub": "" if text else "empty"}
