"""Regular inflections of English words as native expressions.

Each slot is a list of rules (pattern, letters cut, ending, region), tried in order; the first that
fits gives the form. The same table gives the Spark expression and the SQL that checks it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of words that change their spelling before an ending.
SIBILANT = "(?:s|x|z|ch|sh)$"
CONSONANT_Y = "[^aeiou]y$"
CONSONANT_O = "[^aeiou]o$"
ONE_SYLLABLE_CVC = "^(?:y|[^aeiouy])?[^aeiouy]*(?:qu)?[aeiou][^aeiouwxy]$"
MORE_SYLLABLES_C = "[aeiouy][^aeiouy]+[aeiouy]+[^aeiouy]*c$"
BRITISH_L = "(?:[aeiouy][^aeiouy]+[aeiou]|ia|ua|ue|io)l$"

Rule = tuple[str, int, str, str]


def _suffix(ending: str) -> list[Rule]:
    """Rules of an ending that begins with a vowel."""
    soft = [("ie$", 2, "ying", ""), ("^.{2,}[^eoyi]e$", 1, "ing", "")] if ending == "ing" else [("e$", 0, ending[1:], ""), (CONSONANT_Y, 1, "i" + ending, "")]
    hard = [(MORE_SYLLABLES_C, 0, "k" + ending, "")] if ending in ("ing", "ed") else []
    british = [(BRITISH_L, 0, ending, "US"), (BRITISH_L, 0, "l" + ending, "GB")] if ending in ("ing", "ed") else []
    return [*soft, *hard, (ONE_SYLLABLE_CVC, 0, "+" + ending, ""), *british, (".", 0, ending, "")]


_S: list[Rule] = [("^..+sis$", 2, "es", ""), (ONE_SYLLABLE_CVC.replace("[^aeiouwxy]$", "z$"), 0, "zes", ""), (SIBILANT, 0, "es", ""), (CONSONANT_Y, 1, "ies", ""), (CONSONANT_O, 0, "es", ""), (".", 0, "s", "")]
#: "+" in an ending stands for the word's last letter once more.
RULES: dict[tuple[str, str], list[Rule]] = {
    ("noun", "Plur"): _S, ("verb", "3Sg"): _S, ("verb", "Past"): _suffix("ed"), ("verb", "PastPart"): _suffix("ed"), ("verb", "PresPart"): _suffix("ing"),
    ("adjective", "Cmp"): _suffix("er"), ("adjective", "Sup"): _suffix("est"),
}


def _steps(rules: list[Rule]) -> list[list[Rule]]:
    """Rules with the same pattern give alternatives of one step."""
    steps: list[list[Rule]] = []
    for r in rules:
        if steps and steps[-1][0][0] == r[0]:
            steps[-1].append(r)
        else:
            steps.append([r])
    return steps


def _form(word: Column, rule: Rule) -> Column:
    _, cut, ending, region = rule
    stem = F.substring(word, 1, 1000) if not cut else F.substr(word, F.lit(1), F.length(word) - cut)
    tail = F.concat(F.right(word, F.lit(1)), F.lit(ending[1:])) if ending.startswith("+") else F.lit(ending)
    return F.struct(F.concat(stem, tail).alias("form"), F.lit(region).alias("region"))


def forms(word: Column, pos: Column) -> Column:
    """ARRAY<STRUCT<slot, form, region>> of a lower-case word; empty for other parts of speech, null for null."""
    slots = []
    for (own, slot), rules in RULES.items():
        out = F.array().cast("array<struct<form:string,region:string>>")
        for step in reversed(_steps(rules)):
            out = F.when(word.rlike(step[0][0]), F.array(*(_form(word, r) for r in step))).otherwise(out)
        slots.append(F.when(pos == own, _named(out, slot)).otherwise(F.array().cast("array<struct<slot:string,form:string,region:string>>")))
    return F.concat(*slots)


def _named(rows: Column, slot: str) -> Column:
    return F.transform(rows, lambda f: F.struct(F.lit(slot).alias("slot"), f["form"].alias("form"), f["region"].alias("region")))


def sql(word: str, pos: str) -> str:
    """The same as a list of structs in DuckDB."""
    parts = []
    for (own, slot), rules in RULES.items():
        cases = []
        for step in _steps(rules):
            made = []
            for _, cut, ending, region in step:
                stem = f"{word}[1:length({word}) - {cut}]"
                tail = f"{word}[length({word}):] || '{ending[1:]}'" if ending.startswith("+") else f"'{ending}'"
                made.append(f"{{'slot': '{slot}', 'form': {stem} || {tail}, 'region': '{region}'}}")
            cases.append(f"WHEN regexp_matches({word}, '{step[0][0]}') THEN [{', '.join(made)}]")
        parts.append(f"CASE WHEN {pos} = '{own}' THEN CASE {' '.join(cases)} END ELSE [] END")
    return " || ".join(parts)
