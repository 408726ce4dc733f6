"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

from verbarium.functions.ids import NS_OID
from verbarium.functions.morph import IRREGULAR, RULES
from verbarium.functions.text import FEATURE_TAGS, POS_TAGS


def uuid5(name: str, namespace: str = NS_OID) -> str:
    h = f"sha1(unhex('{namespace.replace('-', '')}') || encode({name}))"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"substr('89ab89ab89ab89ab', ('0x' || substr({h}, 17, 1))::INT + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def norm(x: str) -> str:
    return f"lower(nfc_normalize(regexp_replace(coalesce({x}, ''), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')))"


def pos(x: str) -> str:
    return f"CASE lower(trim({x})) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in POS_TAGS.items()) + " ELSE 'OTHER' END"


def tags(x: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({x}, ''), ';'), lambda t: upper(trim(t))), lambda t: t <> '')"


def tags_pos(t: str) -> str:
    return f"CASE WHEN list_contains({t}, 'V') THEN 'VERB' WHEN list_contains({t}, 'N') THEN 'NOUN' WHEN list_contains({t}, 'ADJ') THEN 'ADJECTIVE' WHEN list_contains({t}, 'ADV') THEN 'ADVERB' ELSE 'OTHER' END"


def feature(t: str, name: str) -> str:
    return "CASE " + " ".join(f"WHEN list_contains({t}, '{tag}') THEN '{v}'" for tag, a, v in reversed(FEATURE_TAGS) if a == name) + " END"


def rank(x: str) -> str:
    return f"CASE WHEN {x} LIKE 'OEWN%' THEN 0 WHEN {x} LIKE 'WIKTIONARY%' THEN 1 WHEN {x} LIKE 'UNIMORPH%' THEN 2 WHEN {x} LIKE 'SUBTLEX%' THEN 3 ELSE 4 END"


def form_type(lemma: str, surface: str) -> str:
    out = f"CASE WHEN {lemma} = {surface} THEN 'BASE'"
    for kind in ("SUPPLETIVE", "IRREGULAR"):
        pairs = ", ".join(f"('{a}', '{s}')" for a, _, _, s, k in IRREGULAR if k == kind)
        out += f" WHEN ({lemma}, {surface}) IN ({pairs}) THEN '{kind}'"
    return out + " ELSE 'INFLECTED' END"


def slot(lemma: str, p: str, s: str) -> str:
    out = "CASE"
    for rp, rs, ending, cut, suffix, double in RULES:
        if (rp, rs) == (p, s):
            hit = f"regexp_matches({lemma}, '{ending}')" if ending else "true"
            out += f" WHEN {hit} THEN substr({lemma}, 1, len({lemma}) - {cut}) || {f'{lemma}[-1:] || ' if double else ''}'{suffix}'"
    return out + " END"


LEX = f"""
nl AS (SELECT id claim_id, source, subject raw_lemma, {norm('subject')} lemma, {pos("json_extract_string(object_json, '$.pos')")} pos
  FROM staging_claims WHERE claim_type IN ('LEXICAL_ENTRY', 'LEXICAL_RECORD')),
lex AS (SELECT lemma normalized_lemma, pos, 'eng:' || lemma || ':' || pos lexeme_key, {uuid5("'eng:' || lemma || ':' || pos")} id,
    array_to_string(list_sort(list(DISTINCT source)), ',') sources, arg_min(raw_lemma, row({rank('source')}, source, raw_lemma)) lemma, count(*) n_claims
  FROM nl WHERE lemma <> '' GROUP BY lemma, pos)
"""
FORMS = f"""
nf AS (SELECT id claim_id, source, subject raw_lemma, {norm('subject')} lemma, json_extract_string(object_json, '$.surface') surface,
    json_extract_string(object_json, '$.features') features, {tags_pos(tags("json_extract_string(object_json, '$.features')"))} pos
  FROM staging_claims WHERE claim_type = 'INFLECTION_RECORD'),
nfs AS (SELECT *, {norm('surface')} ns, coalesce(features, '') f FROM nf WHERE trim(surface) <> ''),
hf AS (SELECT DISTINCT l.id subject_id, {uuid5("'eng:' || ns || ':' || f")} object_id, claim_id FROM nfs JOIN lex l ON l.normalized_lemma = nfs.lemma AND l.pos = nfs.pos)
"""
