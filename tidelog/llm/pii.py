"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans. What has a checksum must pass it: card numbers Luhn's, account numbers the one
modulo 97; addresses and telephone numbers have bounds on their parts. The words near a span raise or lower its score.

The proposals of the first rule of ``email``, ``ip``, ``card`` and ``phone`` that pass are always kept. Further rules look
at what is left of a text, where the spans of the same kind are blanked, and keep proposals with a score of ``KEEP`` or
more. Spans of one kind never overlap; those of two kinds may.

Spark's functions give the matches of an expression and the text between them, but not where they are: a match begins
after all the text and all the matches before it. Those sums go by blocks, so a text with very many matches is no
quadratic case. No expression below goes over a stretch of text twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")

# An added span needs this score. Words nearby raise or lower a score by STEP.
KEEP = 0.5
STEP = 0.2

# Characters before and after a span in which words are looked for.
BEFORE, AFTER = 48, 24

# Words that speak for and against a kind, in English, German, French and Spanish.
FOR = {
    "email": "mail email e-mail contact write kontakt schreiben courriel écrire correo escribir",
    "ip": "ip ipv4 ipv6 host server client login address adresse dirección serveur servidor",
    "card": "card credit debit visa mastercard amex karte kreditkarte carte bancaire tarjeta crédito",
    "phone": "phone tel call mobile cell fax sms telefon handy anruf téléphone appelez portable teléfono móvil llame",
    "iban": "iban account bank bic swift konto banque compte banco cuenta",
    "ssn": "ssn social security insurance sozialversicherung sécurité sociale seguridad social",
}
AGAINST = {
    "email": "",
    "ip": "version release build section chapter",
    "card": "isbn order serial tracking invoice hash timestamp",
    "phone": "isbn order serial tracking invoice part",
    "iban": "",
    "ssn": "order serial part invoice",
}

# Lengths of account numbers by country, a fixed value.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def let(name: str, value: str, body: str) -> str:
    """``body``, in which ``name`` stands for a value that is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def total(numbers: str) -> str:
    return f"aggregate({numbers}, 0L, (a, x) -> a + x)"


def sums_before(numbers: str) -> str:
    """For each of the numbers the sum of those before it; n numbers take n times the root of n steps."""
    inside = f"transform(part, (x, i) -> {total('slice(sums, 1, k)')} + {total('slice(part, 1, i)')})"
    body = let("sums", f"transform(parts, p -> {total('p')})", f"flatten(transform(parts, (part, k) -> {inside}))")
    cut = "transform(sequence(0, int((size(v) - 1) div side)), k -> slice(v, int(k * side + 1), side))"
    return let("v", numbers, let("side", "greatest(1, int(ceil(sqrt(size(v)))))", let("parts", cut, body)))


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), c -> c != '')"


def luhn(match: str) -> str:
    """13 to 19 digits of which every second, counted from the last, doubled, they sum up to a multiple of 10."""
    weighed = "transform(ds, (d, i) -> if(i % 2 = 0, d, 2 * d - if(d > 4, 9, 0)))"
    summed = let("ds", f"transform({_chars('reverse(found)')}, c -> cast(c as bigint))", f"{total(weighed)} % 10 = 0")
    return let("found", f"regexp_replace({match}, '[^0-9]', '')", f"if(length(found) between 13 and 19, {summed}, false)")


def mod97(match: str) -> str:
    """The number that letters and digits of an account number make, first four last, leaves 1 modulo 97."""
    step = "(rest, c) -> if(ascii(c) < 65, (rest * 10 + ascii(c) - 48) % 97, (rest * 100 + ascii(c) - 55) % 97)"
    turned = _chars("concat(substring(account, 5), substring(account, 1, 4))")
    return let("account", f"regexp_replace({match}, '[ -]', '')", f"aggregate({turned}, 0L, {step}) = 1")


def _phone(match: str) -> str:
    return f"length(regexp_replace({match}, '[^0-9]', '')) between 9 and 15"


def _ssn(match: str) -> str:
    return f"not {match} rlike '^(?:000|666|9)|-00-|-0000$'"


_BYTE = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def _ip(match: str) -> str:
    return rf"{match} rlike r'^(?:{_BYTE}\.){{3}}{_BYTE}$'"


def _any(match: str) -> str:
    return "true"


@dataclass(frozen=True)
class Rule:
    """``pattern`` proposes where a text has ``gate``, ``sound`` confirms, ``score`` is that of a confirmed proposal."""

    kind: str
    gate: str
    pattern: str
    sound: Callable[[str], str]
    score: float


# A name or a number that has begun before is not looked at again, but for the end of a match: \G.
_NAME = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
_ALONE, _ENDS = "(?<![0-9])", "(?![0-9])"

BASE = (
    Rule("email", "@", _NAME + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.9),
    Rule("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 0.6),
    Rule("card", r"[0-9][ -]?[0-9]", r"[0-9](?:[ -]?[0-9])++", luhn, 0.8),
    Rule("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", _phone, 0.7),
)

_AT, _DOT = r"(?: ?[(\[{] ?(?i:at) ?[)\]}] ?)", r"(?:\.| ?[(\[{] ?(?i:dot) ?[)\]}] ?)"
# A number is taken as long as its country has it, whatever stands behind it.
_IBAN = "|".join(
    rf"(?:{'|'.join(c for c, n in IBAN_LENGTHS.items() if n == size)})[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{size - 4}}}"
    for size in sorted(set(IBAN_LENGTHS.values()))
)
# Numbers that stand together, which the first rule takes for one, and other marks between the groups.
_GAP = r"[ .\u00A0-]"
_CARD = rf"[0-9]{{13,19}}|[0-9]{{4}}({_GAP})[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}|[0-9]{{4}}({_GAP})[0-9]{{6}}\2[0-9]{{5}}"
_AREA = r"(?:\+?(?<![0-9])[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
_PLUS = r"\+[0-9]{1,3}[ .-]?[0-9]{2,4}[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}"
_IPV6, _IPV6_SHORT = "(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}", "(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}"

ADDED = (
    Rule("email", r"[(\[{] ?[aA][tT] ?[)\]}]", rf"{_NAME}{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++", _any, 0.7),
    Rule("email", " [dD][oO][tT] ", rf"{_NAME} (?i:at) [A-Za-z0-9-]++(?: (?i:dot) [A-Za-z0-9-]++)++", _any, 0.4),
    Rule("ip", "(?::[0-9A-Fa-f]{1,4}){7}", rf"(?<![0-9A-Za-z:]){_IPV6}(?![0-9A-Za-z:])", _any, 0.7),
    Rule("ip", "::[0-9A-Fa-f]", rf"(?<![0-9A-Za-z:]){_IPV6_SHORT}(?![0-9A-Za-z:])", _any, 0.4),
    Rule("card", rf"[0-9]{{13}}|[0-9]{{4}}{_GAP}[0-9]{{4}}", rf"{_ALONE}(?:{_CARD}){_ENDS}", luhn, 0.6),
    Rule("phone", r"\+[0-9]|\([0-9]{3}\)", rf"(?:{_AREA}|{_PLUS}){_ENDS}", _phone, 0.6),
    Rule("phone", "[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}", r"(?<![0-9.+-])[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9-]|\.[0-9])", _any, 0.4),
    Rule("iban", "[A-Z]{2}[0-9]{2}", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", mod97, 0.9),
    Rule("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn, 0.4),
)


def _near(words: str) -> str:
    return rf"near rlike r'(?i)(?<![\p{{L}}])(?:{'|'.join(words.split())})(?![\p{{L}}])'" if words else "false"


SPAN = "struct<start:bigint,end:bigint,kind:string,score:double,base:boolean>"
_NONE, _NO_SPANS = "cast(array() as array<string>)", f"cast(array() as array<{SPAN}>)"


def _spans(rule: Rule, base: bool) -> str:
    """One entry for each of ``hits``: its span with the rule's score, changed by words near it; null if it isn't kept."""
    near = f"concat_ws(' ', substring(element_at(gaps, i + 1), -{BEFORE}, {BEFORE}), substring(element_at(gaps, i + 2), 1, {AFTER}))"
    score = f"if({_near(FOR[rule.kind])}, {STEP}D, 0D) - if({_near(AGAINST[rule.kind])}, {STEP}D, 0D)"
    score = let("near", near, f"round(least(1D, {rule.score}D + {score}), 2)")
    start = "element_at(before, i + 1) + length(element_at(gaps, i + 1))"
    span = f"named_struct('start', start, 'end', start + length(hit), 'kind', '{rule.kind}', 'score', score, 'base', {str(base).lower()})"
    kept = "true" if base else f"score >= {KEEP}D"
    made = let("start", start, let("score", score, f"if({kept}, {span}, null)"))
    wide = "transform(gaps, (g, i) -> length(g) + coalesce(length(get(hits, i)), 0L))"
    return let("before", sums_before(wide), f"transform(hits, (hit, i) -> if({rule.sound('hit')}, {made}, null))")


# The text put together again, with what was found replaced by line ends.
_SHOWN = "coalesce(if(get(found, i) is null, get(hits, i), repeat('\n', length(get(hits, i)))), '')"
_BLANKED = f"concat_ws('', transform(gaps, (g, i) -> concat(g, {_SHOWN})))"


def _look(rows: DataFrame, rules: list[tuple[Rule, bool]]) -> DataFrame:
    """Adds what rules of different kinds find in ``left_<kind>`` to ``spans_<kind>``, and blanks it there."""
    steps = {
        "hits": lambda r, base: f"if(left_{r.kind} rlike r'{r.gate}', regexp_extract_all(left_{r.kind}, r'{r.pattern}', 0), {_NONE})",
        "gaps": lambda r, base: f"if(size(hits_{r.kind}) > 0, split(left_{r.kind}, r'{r.pattern}', -1), {_NONE})",
        "found": lambda r, base: f"if(size(hits_{r.kind}) > 0, {let('hits', f'hits_{r.kind}', let('gaps', f'gaps_{r.kind}', _spans(r, base)))}, {_NO_SPANS})",
    }
    for name, made in steps.items():
        rows = rows.withColumns({f"{name}_{r.kind}": F.expr(made(r, base)) for r, base in rules})
    put = {}
    for kind in (r.kind for r, _ in rules):
        text = let("hits", f"hits_{kind}", let("gaps", f"gaps_{kind}", let("found", f"found_{kind}", _BLANKED)))
        put[f"left_{kind}"] = F.expr(f"if(exists(found_{kind}, s -> s is not null), {text}, left_{kind})")
        put[f"spans_{kind}"] = F.expr(f"concat(spans_{kind}, filter(found_{kind}, s -> s is not null))")
    return rows.withColumns(put).drop(*[f"{part}_{r.kind}" for r, _ in rules for part in steps])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, spans``: the personal data of every row, with kind, start, end (exclusive), score and ``base``.

    Places count code points from 0. Spans stand by kind as in ``KINDS``, then start. A null text is the empty one and
    has no spans. Repeated rows and null ids are rows like others. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns({f"{name}_{k}": c for k in KINDS for name, c in (("left", F.col("text")), ("spans", F.expr(_NO_SPANS)))})
    waiting = [(rule, True) for rule in BASE] + [(rule, False) for rule in ADDED]
    while waiting:  # the first waiting rule of every kind, on what the ones before it left
        turn = {rule.kind: (rule, base) for rule, base in reversed(waiting)}
        rows = _look(rows, list(turn.values()))
        waiting = [x for x in waiting if x not in turn.values()]
    spans = F.concat(*[F.array_sort(f"spans_{k}") for k in KINDS])
    return rows.select("doc_id", "text", spans.alias("spans"))


def listing(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))
