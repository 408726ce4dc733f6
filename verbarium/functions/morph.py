"""Regular English inflection as data: rules of (ending, characters cut, suffix), first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spelling patterns and rules that forms must follow; consonant, vowel and a last consonant that doubles.
_DOUBLING = "[bcdfghjklmnpqrstvwxyz][aeiou][bcdfgklmnprtvz]$"
_CONSONANT_Y = "(?:^|[^aeiou])y$"
#: (part of speech, slot, ending, characters cut, suffix, last letter doubled), in order of preference.
RULES = [
    ("VERB", "pres_3sg", "(?:s|sh|ch|x|z)$", 0, "es", False),
    ("VERB", "pres_3sg", _CONSONANT_Y, 1, "ies", False),
    ("VERB", "pres_3sg", "", 0, "s", False),
    ("VERB", "participle_pres", "ee$", 0, "ing", False),
    ("VERB", "participle_pres", "ie$", 2, "ying", False),
    ("VERB", "participle_pres", "e$", 1, "ing", False),
    ("VERB", "participle_pres", _DOUBLING, 0, "ing", True),
    ("VERB", "participle_pres", "", 0, "ing", False),
    ("VERB", "past", "e$", 0, "d", False),
    ("VERB", "past", _CONSONANT_Y, 1, "ied", False),
    ("VERB", "past", _DOUBLING, 0, "ed", True),
    ("VERB", "past", "", 0, "ed", False),
    ("ADJECTIVE", "comparative", "e$", 0, "r", False),
    ("ADJECTIVE", "comparative", _CONSONANT_Y, 1, "ier", False),
    ("ADJECTIVE", "comparative", "", 0, "er", False),
    ("ADJECTIVE", "superlative", "e$", 0, "st", False),
    ("ADJECTIVE", "superlative", _CONSONANT_Y, 1, "iest", False),
    ("ADJECTIVE", "superlative", "", 0, "est", False),
    ("NOUN", "plural", "(?:s|sh|ch|x)$", 0, "es", False),
    ("NOUN", "plural", "", 0, "s", False),
]
# Irregular forms by lemma, part of speech and slot, with their kind.
IRREGULAR = [
    ("go", "VERB", "past", "went", "SUPPLETIVE"), ("go", "VERB", "participle_past", "gone", "SUPPLETIVE"),
    ("run", "VERB", "past", "ran", "IRREGULAR"), ("run", "VERB", "pres_3sg", "runs", "INFLECTED"), ("run", "VERB", "participle_pres", "running", "INFLECTED"),
    ("be", "VERB", "pres_1sg", "am", "SUPPLETIVE"), ("be", "VERB", "pres_3sg", "is", "SUPPLETIVE"), ("be", "VERB", "pres_pl", "are", "SUPPLETIVE"),
    ("be", "VERB", "past_sg", "was", "SUPPLETIVE"), ("be", "VERB", "past_pl", "were", "SUPPLETIVE"),
    ("good", "ADJECTIVE", "comparative", "better", "SUPPLETIVE"), ("good", "ADJECTIVE", "superlative", "best", "SUPPLETIVE"),
    ("bad", "ADJECTIVE", "comparative", "worse", "SUPPLETIVE"), ("bad", "ADJECTIVE", "superlative", "worst", "SUPPLETIVE"),
    ("mouse", "NOUN", "plural", "mice", "IRREGULAR"), ("child", "NOUN", "plural", "children", "IRREGULAR"),
]
SLOT_FEATURES = {
    "pres_3sg": {"tense": "present", "person": "third", "number": "singular"},
    "participle_pres": {"aspect": "progressive", "form_category": "participle"},
    "participle_past": {"aspect": "perfect", "form_category": "participle"},
    "past": {"tense": "past"}, "past_sg": {"tense": "past", "number": "singular"}, "past_pl": {"tense": "past", "number": "plural"},
    "pres_1sg": {"tense": "present", "person": "first", "number": "singular"}, "pres_pl": {"tense": "present", "number": "plural"},
    "comparative": {"degree": "comparative"}, "superlative": {"degree": "superlative"}, "plural": {"number": "plural"},
}


def regular_form(lemma: Column, pos: str, slot: str) -> Column:
    """The form that the rules give a lemma in a slot."""
    out = None
    for p, s, ending, cut, suffix, double in RULES:
        if (p, s) != (pos, slot):
            continue
        stem = F.substring(lemma, F.lit(1), F.length(lemma) - cut)
        form = F.concat(stem, F.substring(lemma, -1, 1), F.lit(suffix)) if double else F.concat(stem, F.lit(suffix))
        hit = lemma.rlike(ending) if ending else F.lit(True)
        out = F.when(hit, form) if out is None else out.when(hit, form)
    return out


def irregular_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(IRREGULAR, "lemma string, pos string, slot string, surface string, form_type string")


def inflect(lexemes: DataFrame) -> DataFrame:
    """``(lemma, pos, slot, surface, form_type)`` for distinct ``(lemma, pos)``: regular slots, irregular ones first.

    ``lemma`` is taken as normalised. Parts of speech without rules, and null or empty lemmas, have no slots.
    """
    base = lexemes.select("lemma", "pos").filter("lemma <> '' and pos in ('VERB', 'ADJECTIVE', 'NOUN')").distinct()
    slots = list(dict.fromkeys((p, s) for p, s, *_ in RULES))
    made = F.array(*[F.when(F.col("pos") == p, F.struct(F.lit(s).alias("slot"), regular_form(F.col("lemma"), p, s).alias("surface"))) for p, s in slots])
    regular = base.select("lemma", "pos", F.inline(F.filter(made, lambda x: x.isNotNull())))
    odd = F.broadcast(irregular_table(lexemes.sparkSession))  # a fixed table
    kept = regular.join(odd, ["lemma", "pos", "slot"], "left_anti").withColumn("form_type", F.lit("INFLECTED"))
    return kept.unionByName(base.join(odd, ["lemma", "pos"]))


def form_type(lemma: Column, surface: Column) -> Column:
    """BASE, SUPPLETIVE, IRREGULAR or INFLECTED."""
    out = F.when(lemma == surface, "BASE")
    for kind in ("SUPPLETIVE", "IRREGULAR"):
        out = out.when(F.concat(lemma, F.lit(" "), surface).isin([f"{a} {s}" for a, _, _, s, k in IRREGULAR if k == kind]), kind)
    return out.otherwise("INFLECTED")
