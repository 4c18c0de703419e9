"""Surrogates for personal data, in DataFrame operations only.

Entities are found by patterns and split into atoms (an address into its local part and domain, a
name into given name and surname). Every distinct atom of the corpus gets one surrogate, drawn
from a digest of a secret, its kind and itself, so that the same thing has the same surrogate
wherever it occurs and however it is written. Surrogates that fall together, or on something
real, are drawn again. Each occurrence is then written in the format it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutrank.session import written

# Given names by script and gender.
GIVEN = {
    ("latin", "f"): "Alice Anna Carmen Clara Elena Emma Eva Greta Hannah Helga Ingrid Julia Laura Lucia Maria Marie "
    "Mary Paula Petra Sarah Sofia Susan Teresa Ursula".split(),
    ("latin", "m"): "Antonio Carlos David Diego Ernst Felix Hans Henry Jacques James John Jorge Jose Karl Luis Marco "
    "Michael Miguel Otto Paul Peter Pierre Robert Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Наталья Ольга Татьяна".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Дмитрий Иван Николай Павел Сергей".split(),
}
# Titles that stand before a surname.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Monsieur Madame Господин Госпожа".split()
# Parts of which surnames are made.
SYLLABLES = {
    "latin": "bar ben dal den dor fal fen gar hal han kel kin lan lor mar mel mer mor nar nel ral ren ros sal ser sol "
    "tal tan tor val ven wal".split(),
    "cyrillic": "бар вел гор дан жар зор кал лев мар нор пол рад сал тор фил чер".split(),
}

_SURNAME = r"\p{Lu}[\p{Ll}]+(?:-\p{Lu}[\p{Ll}]+)?"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_FREE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_APART, _ENDS = r"(?<![\p{L}\p{N}+])(?<![0-9][-./])", r"(?![\p{L}\p{N}]|[-./][0-9])"
_names = "|".join(n for names in GIVEN.values() for n in names)

#: Kind of entity -> pattern. Every pattern starts where no letter or digit stands before and does not
#: back up over long words, so a text of one word takes linear time.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,24}" + _END,
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.[0-9])",
    "ipv6": r"(?<![\p{L}\p{N}:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    + r"|(?:(?:[0-9A-Fa-f]{1,4}:){2,6}|[Ff][Ee]80:)(?::[0-9A-Fa-f]{1,4}){1,5})(?![\p{L}\p{N}:])",
    # with a country code; of pairs of digits; of 3, 3 and 4 digits; of an area code from 0 and a number
    "phone": r"(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,5}){2,4}" + _END
    + r"|(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3} ?(?:\(0\) ?)?[1-9]|0[1-9])(?:[ .-][0-9]{2}){4}" + _END
    + r"|" + _APART + r"(?:1[-. ])?[0-9]{3}(?:-[0-9]{3}-|\.[0-9]{3}\.)[0-9]{4}" + _ENDS
    + r"|" + _APART + r"0[1-9][0-9]{1,3}[ /-][0-9]{5,8}" + _ENDS
    + r"|(?<![\p{L}\p{N}])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}" + _END,
    "ssn": _FREE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END,
    "card": _FREE + r"(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})" + _END,
    "iban": _FREE + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}| [A-Z0-9]{4}(?: [0-9]{4}){2,6}(?: [0-9]{1,3})?)" + _END,
    "secret": _FREE + r"(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _END,
    "name": _FREE + rf"(?:(?:{_names}) {_SURNAME}|(?:{'|'.join(TITLES)})\.? {_SURNAME})" + _END,
}
SAME_RANGE = 6
LEAST_BARE = 3  # letters of a surname that is replaced where it stands alone
NOT_REAL = 12
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_HINT = "[0-9@]|" + _FREE + f"(?:{_names}|{'|'.join(TITLES)})" + _END  # what every entity has


def _sql(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind(value: str) -> str:
    """The kind of a value, that of the first pattern which matches all of it; ``bare`` for a part of a name."""
    cases = " ".join(f"WHEN rlike({value}, {_sql(f'^(?:{p})$')}) THEN '{k}'" for k, p in PATTERNS.items())
    return f"CASE {cases} ELSE 'bare' END"


def _given_index() -> str:
    """Map from given name to (script, gender, place), as SQL."""
    rows = [
        f"{_sql(n)}, named_struct('list', '{script}_{gender}', 'place', {i})"
        for (script, gender), names in GIVEN.items()
        for i, n in enumerate(names)
    ]
    return f"map({', '.join(rows)})"


def _atoms(kind: str, value: str) -> str:
    """Array of (kind, atom), in the canonical form in which mentions of one thing agree."""
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    last = f"element_at(split({value}, ' '), -1)"
    first = f"split({value}, ' ')[0]"
    script = f"IF(rlike({last}, '[\\\\p{{IsCyrillic}}]'), 'cyrillic', 'latin')"
    pair = "named_struct('kind', {}, 'atom', {})".format
    return f"""CASE {kind}
        WHEN 'email' THEN array({pair("'local'", f"lower(substring_index({value}, '@', 1))")},
                                {pair("'domain'", f"lower(substring_index({value}, '@', -1))")})
        WHEN 'phone' THEN array({pair("'phone'", f"concat(IF(startswith({value}, '+'), '+', ''), {digits})")})
        WHEN 'card' THEN array({pair("'card'", digits)})
        WHEN 'ssn' THEN array({pair("'ssn'", digits)})
        WHEN 'secret' THEN array({pair("IF(rlike(" + value + ", '^[0-9a-fA-F]+$'), 'hex', 'secret')",
                                       f"IF(rlike({value}, '^[0-9a-fA-F]+$'), lower({value}), {value})")})
        WHEN 'name' THEN array({pair("'given'", first)}, {pair(f"concat('surname_', {script})", f"lower({last})")})
        WHEN 'bare' THEN array(IF(try_element_at({_given_index()}, {value}) IS NOT NULL, {pair("'given'", value)},
                                  {pair(f"concat('surname_', {script})", f"lower({value})")}))
        WHEN 'iban' THEN array({pair("'iban'", f"replace({value}, ' ', '')")})
        WHEN 'ipv6' THEN array({pair("'ipv6'", f"lower({value})")})
        ELSE array({pair(kind, value)}) END"""


def _draw(n: str | int, i: str = "i") -> str:
    """A number below ``n`` from the seed."""
    return f"int(pmod(xxhash64(seed, {i}), {n}))"


def _chars(atom: str, keep: str = "false") -> str:
    """The atom with every letter and digit drawn anew in its class."""
    c = f"substring({atom}, i, 1)"
    letters = "'abcdefghijklmnopqrstuvwxyz'"
    return f"""array_join(transform(sequence(1, length({atom})), i -> CASE
        WHEN {keep} THEN {c}
        WHEN rlike({c}, '[0-9]') THEN string({_draw(10)})
        WHEN kind IN ('hex', 'ipv6') AND rlike({c}, '[a-f]') THEN substring('abcdef', 1 + {_draw(6)}, 1)
        WHEN rlike({c}, '[a-z]') THEN substring({letters}, 1 + {_draw(26)}, 1)
        WHEN rlike({c}, '[A-Z]') THEN substring(upper({letters}), 1 + {_draw(26)}, 1)
        ELSE {c} END), '')"""


def _luhn(digits: str) -> str:
    """The Luhn sum of a string of digits, from the right, modulo 10."""
    d = f"int(substring({digits}, length({digits}) - i, 1))"
    double = f"IF(2 * {d} > 9, 2 * {d} - 9, 2 * {d})"
    each = f"transform(sequence(0, length({digits}) - 1), i -> IF(i % 2 = 1, {double}, {d}))"
    return f"aggregate({each}, 0, (a, x) -> a + x) % 10"


def _surrogates(atoms: DataFrame, secret: str) -> DataFrame:
    """Add the surrogate of every (kind, atom, attempt)."""
    seed = F.sha2(F.concat_ws("|", F.lit(secret), "kind", "atom", F.col("attempt").cast("string")), 256)
    rows = atoms.withColumn("seed", seed)
    card = _chars("atom", "i = 1")
    rows = rows.withColumn("drawn", F.when(F.col("kind") == "card", F.expr(card)))
    # the last digit makes the check sum what it was: right stays right, wrong stays wrong
    fixed = f"""concat(left(drawn, length(drawn) - 1),
        string(pmod(int(right(drawn, 1)) - ({_luhn('drawn')}) + ({_luhn('atom')}), 10)))"""
    octet = f"transform(split(atom, '[.]'), (o, i) -> string(1 + {_draw(254)}))"
    private = r"^(?:10|127|192[.]168|172[.](?:1[6-9]|2[0-9]|3[01]))[.]"
    inner = f"""IF(attempt > {SAME_RANGE}, array_join({octet}, '.'), concat(regexp_extract(atom, {_sql(private)}, 0), array_join(slice({octet},
        1 + size(split(regexp_extract(atom, {_sql(private)}, 0), '[.]')) - 1,
        5 - size(split(regexp_extract(atom, {_sql(private)}, 0), '[.]'))), '.')))"""
    # the first group stays; where the format has few values, later attempts fill the groups
    group = "IF(i = 0 OR g = '', g, substring(sha2(concat(seed, string(i)), 256), 1, 4))"
    ipv6 = f"""IF(attempt > {SAME_RANGE}, array_join(transform(split(atom, ':'), (g, i) -> {group}), ':'),
        {_chars('atom', "i <= instr(atom, ':')")})"""
    # the part after the last point of a domain stays, as does the country of an IBAN
    end = "length(substring_index(atom, '.', -1))"
    cases = [
        ("kind = 'card'", fixed),
        ("kind = 'ip'", inner),
        ("kind = 'ipv6'", ipv6),
        ("kind = 'phone'", _chars("atom", "i <= 2")),
        ("kind = 'domain'", _chars("atom", f"i >= length(atom) - {end}")),
        ("kind = 'iban'", _chars("atom", "i <= 2")),
        ("kind = 'secret'", _chars("atom", "i <= IF(startswith(atom, 'AKIA') OR startswith(atom, 'ghp_'), 4, 3)")),
        ("kind = 'given'", _other_given()),
        *((f"kind = 'surname_{s}'", _surname(s)) for s in SYLLABLES),
    ]
    picked = "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in cases) + f" ELSE {_chars('atom')} END"
    # where a format has few values, later attempts are longer
    few, digits = "kind IN ('local', 'domain', 'phone')", "string({})".format
    longer = f"""CASE WHEN attempt > 3 AND {few} THEN concat({digits(_draw('pow(10, least(attempt, 9))', '0'))}, p)
        WHEN attempt > {NOT_REAL} AND kind IN ('ssn', 'card', 'iban', 'hex', 'secret')
        THEN concat(p, {digits(_draw('pow(10, least(attempt, 9))', '0'))}) ELSE p END"""
    rows = rows.withColumn("p", F.expr(picked)).withColumn("surrogate", F.expr(longer))
    return rows.select("kind", "atom", "attempt", "surrogate")


def _other_given() -> str:
    """Another given name of the same script and gender: a shift of the list, so no two fall together.

    The shift depends on the secret only. What is not in a list (a title) stays.
    """
    lists = ", ".join(
        f"'{s}_{g}', array({', '.join(_sql(n) for n in names)})" for (s, g), names in GIVEN.items()
    )
    found = f"try_element_at({_given_index()}, atom)"
    names = f"try_element_at(map({lists}), {found}.list)"
    return f"coalesce({names}[({found}.place + 1 + shift % (size({names}) - 1)) % size({names})], atom)"


def _surname(script: str) -> str:
    parts = f"array({', '.join(_sql(s) for s in SYLLABLES[script])})"
    n = len(SYLLABLES[script])
    return f"array_join(transform(sequence(1, 3 + int(attempt / 2)), i -> {parts}[{_draw(n)}]), '')"


def assign(atoms: DataFrame, secret: str) -> DataFrame:
    """(kind, atom, surrogate), one to one within each kind, and never a real atom of that kind.

    ``atoms`` (kind, atom) are distinct. In every step the atoms whose surrogate is settled for another, is drawn by
    a smaller one as well or is real are drawn again, only they, until none is left. Given names are shifted
    within their list, so they are one to one from the start and may be real. So that it ends where a
    format has hardly more values than the corpus, addresses leave their range after ``SAME_RANGE``
    attempts and other formats get longer, the short ones after three attempts and the others after ``NOT_REAL``. There are
    no longer IPv4 addresses: of these a real one will do after ``NOT_REAL`` attempts.
    """
    shift = F.pmod(F.xxhash64(F.sha2(F.lit(secret), 256)), F.lit(1_000_000)).cast("int")
    state = atoms.withColumn("attempt", F.lit(0)).withColumn("shift", shift)
    real = atoms.select("kind", F.col("atom").alias("surrogate"), F.lit(True).alias("real"))
    settled = None
    while True:
        drawn = written(_surrogates(state, secret), "surrogates")
        same = Window.partitionBy("kind", "surrogate").orderBy("atom")
        judged = drawn.join(real, ["kind", "surrogate"], "left")
        if settled is None:
            judged = judged.withColumn("held", F.lit(False))
        else:
            held = settled.select("kind", "surrogate", F.lit(True).alias("held"))
            judged = judged.join(held, ["kind", "surrogate"], "left")
        real_too = F.col("real").isNotNull() & ((F.col("kind") != "ip") | (F.col("attempt") < NOT_REAL))
        taken = (F.row_number().over(same) > 1) | F.coalesce("held", F.lit(False)) | real_too
        judged = judged.withColumn("again", (F.col("kind") != "given") & taken)
        judged = written(judged.select(*drawn.columns, "again"), "judged")
        new = judged.filter("NOT again").select("kind", "atom", "surrogate")
        settled = new if settled is None else settled.unionByName(new)
        again = judged.filter("again")
        if again.isEmpty():
            return settled
        state = again.select("kind", "atom", (F.col("attempt") + 1).alias("attempt"), shift.alias("shift"))


def _render() -> str:
    """The value in the format it had, from its surrogate atoms ``s``."""
    # letter by letter the case of the value, while it is as long
    cased = """array_join(transform(sequence(1, length({0})), i -> IF(
        rlike(substring({1}, i, 1), '[A-Z]'), upper(substring({0}, i, 1)), substring({0}, i, 1))), '')""".format
    local = cased("s[0]", "substring_index(value, '@', 1)")
    domain = cased("s[1]", "substring_index(value, '@', -1)")
    digit = "regexp_replace(s[0], '[^0-9]', '')"
    at = "length(regexp_replace(left(value, i), '[^0-9]', ''))"
    filled = f"""concat(array_join(transform(sequence(1, length(value)), i -> IF(
        rlike(substring(value, i, 1), '[0-9]'), substring({digit}, {at}, 1), substring(value, i, 1))), ''),
        substring({digit}, length(regexp_replace(value, '[^0-9]', '')) + 1))"""
    spaced = """array_join(transform(sequence(1, length(value)), i -> IF(substring(value, i, 1) = ' ', ' ',
        substring(s[0], length(replace(left(value, i), ' ', '')), 1))), '')"""
    iban = f"concat({spaced}, substring(s[0], length(replace(value, ' ', '')) + 1))"
    surname = "IF(value = upper(value), upper({0}), initcap({0}))".format
    return f"""CASE kind
        WHEN 'email' THEN concat({local}, '@', {domain})
        WHEN 'phone' THEN {filled} WHEN 'card' THEN {filled} WHEN 'ssn' THEN {filled}
        WHEN 'secret' THEN IF(rlike(value, '^[0-9A-F]+$'), upper(s[0]), s[0])
        WHEN 'name' THEN concat(s[0], ' ', {surname('s[1]')})
        WHEN 'bare' THEN {surname('s[0]')}
        WHEN 'iban' THEN {iban}
        WHEN 'ipv6' THEN {cased('s[0]', 'value')}
        ELSE s[0] END"""


def _with_bare_names(found: str) -> str:
    """The pattern of a document: all entities, and the parts of the names found in it where they stand alone."""
    full = f"filter({found}, v -> rlike(v, {_sql('^(?:' + PATTERNS['name'] + ')$')}))"
    givens = f"filter(transform({full}, v -> split(v, ' ')[0]), g -> try_element_at({_given_index()}, g) IS NOT NULL)"
    surnames = f"filter(transform({full}, v -> element_at(split(v, ' '), -1)), w -> length(w) >= {LEAST_BARE})"
    parts = f"array_join(array_distinct(concat({givens}, {surnames})), '|')"
    return f"concat({_sql(ANY + '|' + _FREE + '(?:')}, {parts}, {_sql(')' + _END)})"


def surrogate(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Replace the personal data in ``text``; add ``n_entities`` and ``kinds`` (distinct, sorted).

    All rows and columns are kept (columns with the names added are replaced). Equal entities have
    equal surrogates in all documents, under one ``secret``; addresses agree in their domains, phone and
    card numbers by their digits, names in given name and surname. In a document with a name its given name and its
    surname (of ``LEAST_BARE`` letters or more) are also replaced where they stand alone, above and below. Different atoms have
    different surrogates, and no surrogate is an atom that occurs. Kept are: separators, length and
    case; the top-level domain; the first digit of phone and card numbers and whether a card's
    check digit is right; private address ranges; prefixes of secrets; script and gender of given names.

    Texts without an entity, null and empty ones stay as they are and are not shuffled. Repeated
    rows are treated alike. ``key`` is only named for symmetry with the other operators; it may be null.
    """
    kept = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    rows = docs.select(*[f"`{c}`" for c in kept])
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    has = body.rlike(_HINT) & body.rlike(ANY)
    none = rows.filter(~has).withColumn("n_entities", F.lit(0)).withColumn("kinds", F.array().cast("array<string>"))
    some = rows.filter(has)
    some = some.withColumn("_found", F.regexp_extract_all(F.col(f"`{text}`"), F.lit(ANY), F.lit(0)))
    # a document with names is searched once more, for the parts of these names that stand alone
    some = some.withColumn("_pattern", F.expr(_with_bare_names("_found")))
    named = ~F.col("_pattern").endswith("(?:)" + _END)
    again = F.regexp_extract_all(F.col(f"`{text}`"), F.col("_pattern"), F.lit(0))
    some = some.withColumn("_found", F.when(named, again).otherwise(F.col("_found")))
    some = some.withColumn("_pattern", F.when(named, F.col("_pattern")).otherwise(ANY))
    some = some.withColumn("_rest", F.split(F.col(f"`{text}`"), F.col("_pattern"), -1)).drop("_pattern")
    some = written(some.withColumn("_row", F.monotonically_increasing_id()), "entities")

    values = some.select(F.explode("_found").alias("value")).distinct()
    values = values.select("value", F.expr(_kind("value")).alias("kind"))
    values = written(values.select("value", "kind", F.expr(_atoms("kind", "value")).alias("atoms")), "values")
    atoms = values.select(F.explode("atoms").alias("a")).select("a.kind", "a.atom").distinct()
    chosen = assign(written(atoms, "atoms"), secret)
    parts = values.select("value", "kind", F.posexplode("atoms").alias("place", "a"))
    parts = parts.select("value", F.col("kind").alias("entity"), "place", "a.kind", "a.atom")
    parts = parts.join(chosen, ["kind", "atom"]).groupBy("value", F.col("entity").alias("kind"))
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("place", "surrogate"))).alias("s"))
    parts = parts.withColumn("s", F.transform("s", lambda x: x["surrogate"]))
    new = written(parts.select("value", "kind", F.expr(_render()).alias("new")), "rendered")

    used = some.select("_row", F.posexplode("_found").alias("at", "value")).join(new, "value")
    used = used.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("at", "new"))).alias("_new"),
        F.sort_array(F.collect_set(F.expr("IF(kind = 'bare', 'name', kind)"))).alias("kinds"),
    )
    filled = F.transform("_new", lambda x: x["new"])
    whole = F.array_join(
        F.flatten(F.zip_with("_rest", filled, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), ""
    )
    done = some.join(used, "_row")
    columns = [whole.alias(c) if c == text else F.col(f"`{c}`") for c in kept]
    done = done.select(*columns, F.size("_found").alias("n_entities"), "kinds")
    return none.unionByName(done)
