"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built from SQL expressions only. A pattern's matches come from ``regexp_extract_all``, their places
from running sums over the lengths of the pieces that ``split`` leaves between them. Patterns run only on texts that
hold a character they need, and start only where a run of their characters starts, so a long run
is walked once.

Kinds in order: email, ip, card, phone (the base kinds, always reported when their rule holds), then
iban (mod-97), number (a bare telephone-like number), ssn (number groups that are given out), key (the
forms of well-known access keys) and secret (a value with a letter and a digit given to a password, token or
key), reported from a score of ``THRESHOLD`` on and where no base span overlaps them. Added spans of
different kinds may overlap, as base spans may.

Cases: null text counts as empty and has no spans; texts are searched whole; spans of different base
kinds may overlap; equal rows give equal results; an empty table gives an empty result; columns other
than doc_id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Score from which spans of the added kinds are reported.
THRESHOLD = 0.5
#: Code points before and after a match in which context words count (of the two pieces of text before it and
#: the one after it that matches of its kind leave), and what they add.
BEFORE, AFTER = 40, 20
#: Matches whose running states are gathered together.
BLOCK = 128
WITH_CONTEXT, AGAINST_CONTEXT = 0.3, -0.3

_LOCAL = "A-Za-z0-9._%+-"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """``needs`` is a quick test of the text, ``valid`` an SQL test of a match ``v``."""

    name: str
    needs: str
    pattern: str
    valid: str
    score: float
    words: str
    against: str = "version|isbn|issn|invoice|order|tracking|build|page"
    base: bool = True


_DIGITS = "regexp_replace(v, '[^0-9]', '')"
#: Digits of an IBAN's check: its first four characters go to the end, letters become 10 to 35.
_MOD97 = """aggregate(
    split(concat(substring(replace(v, ' ', ''), 5), left(replace(v, ' ', ''), 4)), ''), 0,
    (a, c) -> case when c = '' then a when c between '0' and '9' then (a * 10 + ascii(c) - 48) % 97
                   else (a * 100 + ascii(c) - 55) % 97 end) = 1"""

KINDS = (
    Kind(
        "email",
        "contains(text, '@')",
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "true",
        0.9,
        "mail|e-mail|email|contact|correo|courriel|write|address",
    ),
    Kind(
        "ip",
        "rlike(text, '[0-9][.][0-9]')",
        r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        rf"rlike(v, '^{_PART}(?:[.]{_PART}){{3}}$')",
        0.6,
        "ip|host|server|address|client|login|gateway",
    ),
    Kind(
        "card",
        "rlike(text, '[0-9][ -]?[0-9]')",
        # whole runs of digits with single separators, of 12 to 19 digits
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
        f"luhn_check({_DIGITS})",
        0.7,
        "card|credit|visa|mastercard|payment|karte|tarjeta|carte|cvv|expires",
    ),
    Kind(
        "phone",
        "contains(text, '+')",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        f"length({_DIGITS}) between 9 and 15",
        0.7,
        "phone|tel|call|mobile|cell|fax|telefon|whatsapp|sms",
    ),
    Kind(
        "iban",
        "rlike(text, '[A-Z][A-Z][0-9][0-9]')",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        _MOD97,
        0.8,
        "iban|account|bank|konto|cuenta|compte|bic|swift|transfer",
        base=False,
    ),
    Kind(
        "number",
        "rlike(text, '[0-9][ .-][0-9]')",
        r"(?<![A-Za-z0-9+.,-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![A-Za-z0-9]|[.,-][0-9])",
        f"length({_DIGITS}) between 8 and 13",
        0.3,
        "phone|tel|call|mobile|cell|fax|telefon|whatsapp|sms",
        base=False,
    ),
    Kind(
        "ssn",
        "rlike(text, '[0-9]-[0-9][0-9]-[0-9]')",
        # areas 000, 666 and 9xx, group 00 and serial 0000 are never given out
        r"(?<![A-Za-z0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![A-Za-z0-9-])",
        "true",
        0.5,
        "ssn|social|security|identity|taxpayer|born|applicant|employee",
        base=False,
    ),
    Kind(
        "key",
        "rlike(text, 'A[KS]IA|gh[a-z]_|github_pat_|sk[_-]|rk_|xox|AIza|eyJ|PRIVATE KEY')",
        r"(?<![A-Za-z0-9_])(?:A[KS]IA[0-9A-Z]{16}|gh[opusr]_[A-Za-z0-9]{30,}+|github_pat_[A-Za-z0-9_]{22,}+|"
        r"[sr]k[_-](?:live|test|proj|ant)[_-][A-Za-z0-9_-]{10,}+|sk-[A-Za-z0-9]{20,}+|xox[abeprs]-[A-Za-z0-9-]{10,}+|"
        r"AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}+[.]eyJ[A-Za-z0-9_-]{8,}+[.][A-Za-z0-9_-]{8,}+)|"
        r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----",
        "true",
        0.8,
        "key|token|secret|credential|credentials|aws",
        against="example|placeholder|dummy",
        base=False,
    ),
    Kind(
        "secret",
        "rlike(text, '(?i)passw|secret|token|api[_ -]?key|access[_ -]?key')",
        r"(?i)(?<![a-z0-9])(?:passw(?:or)?d|secret|(?:auth|access|api)?[_-]?token|api[_ -]?key|"
        r"(?:secret[_ -]?)?access[_ -]?key|client[_ -]?secret)[\"\x27]?\x20{0,3}(?:=|:|:=|\bis:)\x20{0,3}[\"\x27]?"
        r"(?-i:(?=[A-Za-z_+/=.!@#%^&*-]{0,40}[0-9])(?=[^A-Za-z\s]{0,40}[A-Za-z]))[^\s\"\x27,;<>(){}]{8,200}+",
        "true",
        0.6,
        "login|user|username|account|config|env|export|credential|credentials",
        against="example|placeholder|dummy|changeme",
        base=False,
    ),
)


def _sql(text: str) -> str:
    """A raw SQL string, so that the backslashes of patterns need no doubling."""
    return "r'" + text + "'"


def _matches(kind: Kind) -> tuple[Column, Column]:
    needs = F.expr(kind.needs)
    return (
        F.when(needs, F.expr(f"regexp_extract_all(text, {_sql(kind.pattern)}, 0)")).alias(
            f"{kind.name}_v"
        ),
        F.when(needs, F.expr(f"split(text, {_sql(kind.pattern)}, -1)")).alias(f"{kind.name}_g"),
    )


def _running(items: str, zero: str, step: str) -> str:
    """State after each item of an array: ``step`` is SQL over the state ``l`` before and the item ``x``.

    Appending copies an array, so states are gathered in blocks and the blocks put together.
    """
    blocks = f"transform(sequence(0, size({items}) - 1, {BLOCK}), i -> slice({items}, i + 1, {BLOCK}))"
    states = f"""aggregate(b, array(element_at(element_at(a, -1), -1)),
        (c, x) -> concat(c, transform(slice(c, -1, 1), l -> {step})))"""
    return f"""flatten(aggregate({blocks}, array(array({zero})),
        (a, b) -> concat(a, array(slice({states}, 2, size(b)))), a -> slice(a, 2, size(a))))"""


def _places(kind: Kind) -> list[Column]:
    """Lengths of the matches with the pieces before them, and the matches with the text near them."""
    v, g = f"{kind.name}_v", f"{kind.name}_g"
    lengths = f"zip_with(slice({g}, 1, size({v})), {v}, (g, v) -> length(g) + length(v))"
    around = f"""transform(sequence(1, size({v})), i -> named_struct('v', element_at({v}, i),
        'near', lower(concat(
            right(concat_ws(' ', right(get({g}, i - 2), {BEFORE}), right(get({g}, i - 1), {BEFORE})), {BEFORE}),
            ' ', left(get({g}, i), {AFTER})))))"""
    return [
        F.expr(f"CASE WHEN size({v}) > 0 THEN {lengths} END").alias(f"{kind.name}_l"),
        F.expr(f"CASE WHEN size({v}) > 0 THEN {around} END").alias(f"{kind.name}_m"),
    ]


def _scored(kind: Kind, order: int) -> Column:
    """Valid matches as (start, order, end, kind, score), empty where there is none."""
    ends = _running(f"{kind.name}_l", "0", "l + x")
    valid = kind.valid.replace("(v,", "(p.m.v,")
    return F.expr(
        f"""coalesce(CASE WHEN size({kind.name}_l) > 0 THEN transform(
            filter(zip_with({ends}, {kind.name}_m, (e, m) -> named_struct('e', e, 'm', m)), p -> {valid}),
            p -> named_struct('s', p.e - length(p.m.v), 'o', {order}, 'e', p.e, 'kind', '{kind.name}',
            'score', greatest(0.0D, least(1.0D, {kind.score}D
                + if(rlike(p.m.near, {_sql(rf"\b(?:{kind.words})\b")}), {WITH_CONTEXT}D, 0.0D)
                + if(rlike(p.m.near, {_sql(rf"\b(?:{kind.against})\b")}), {AGAINST_CONTEXT}D, 0.0D))))) END,
            cast(array() AS array<struct<s:int,o:int,e:int,kind:string,score:double>>))"""
    ).alias(f"{kind.name}_s")


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and ``found``: spans (s, o, e, kind, score) by start, then kind in the listed order.

    s and e count code points, e is exclusive, o is the kind's number. The work grows with the text: an
    added span is held against the furthest end of the base spans before it and the start of the next one.
    """
    read = docs.select("doc_id", text_or_empty(text).alias("text"))
    matched = read.select("doc_id", *(c for k in KINDS for c in _matches(k)))
    placed = matched.select("doc_id", *(c for k in KINDS for c in _places(k)))
    scored = placed.select("doc_id", *(_scored(k, i) for i, k in enumerate(KINDS)))
    base = ", ".join(f"{k.name}_s" for k in KINDS if k.base)
    more = ", ".join(f"{k.name}_s" for k in KINDS if not k.base)
    every = scored.select(
        "doc_id",
        F.expr(f"array_sort(concat({base}, filter(concat({more}), m -> m.score >= {THRESHOLD}D)))").alias("every"),
    )
    is_base = f"x.o < {sum(k.base for k in KINDS)}"
    reached = _running("every", "0", f"if({is_base}, greatest(l, x.e), l)")
    next_start = f"reverse({_running('reverse(every)', '2147483647', f'if({is_base}, x.s, l)')})"
    return every.select(
        "doc_id",
        F.expr(
            f"""CASE WHEN exists(every, x -> NOT {is_base}) THEN
                transform(filter(
                    zip_with(zip_with(every, {reached}, (x, r) -> named_struct('x', x, 'r', r)), {next_start},
                        (y, n) -> named_struct('x', y.x, 'r', y.r, 'n', n)),
                    z -> z.{is_base} OR (z.r <= z.x.s AND z.n >= z.x.e)), z -> z.x)
                ELSE every END"""
        ).alias("found"),
    )


def _joined(condition: str) -> Column:
    return F.expr(
        f"""array_join(transform(filter(found, f -> {condition}),
            f -> concat_ws(':', f.kind, f.s, f.e)), ',')"""
    )


def personal_data_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts of the base kinds, digest of their spans, all spans and their scores, per document."""
    names = [k.name for k in KINDS if k.base]
    found = find_personal_data(docs, text)
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(found, f -> f.o = {i})) AS long)").alias(f"n_{n}") for i, n in enumerate(names)),
        F.sha2(_joined(f"f.o < {len(names)}"), 256).alias("base_sha256"),
        F.size("found").cast("long").alias("n_spans"),
        _joined("true").alias("spans"),
        F.expr("array_join(transform(found, f -> format_number(f.score, 2)), ',')").alias("scores"),
    )
