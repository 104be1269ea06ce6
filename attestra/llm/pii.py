"""Personal data by fixed patterns and weak supervision, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import stage

# The base patterns. Possessive repeats and a look-behind leave the leftmost matches as they are: what follows
# a repeat is never in its class, and a match can only begin where its class begins or the last match ended.
# They keep the regex engine from trying every tail of a long run, and from recursion.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")

# What may be personal data beyond the base kinds. Labelers judge each match: a long word with a digit (keys, tokens,
# passwords), a national telephone number, an address that is spelt out, an account number, an identity number, a
# person's name after a title or with a known given name, and a street address.
SECRET = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+"
LOCAL_PHONE = r"(?<![0-9+().-])(?<![0-9+] )\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
SPELT_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# Gazetteers. Fixed values.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Monsieur", "Madame", "Sr", "Sra", "Srta", "Don", "Señor", "Señora")
GIVEN = (
    "James", "Mary", "Robert", "Patricia", "John", "Jennifer", "Michael", "Linda", "David", "Elizabeth", "William", "Barbara", "Richard", "Susan", "Joseph",
    "Jessica", "Thomas", "Sarah", "Charles", "Karen", "Daniel", "Nancy", "Matthew", "Lisa", "Anthony", "Sandra", "Mark", "Ashley", "Paul", "Emily", "Steven",
    "Hans", "Peter", "Klaus", "Jürgen", "Wolfgang", "Stefan", "Andreas", "Monika", "Ursula", "Petra", "Sabine", "Renate", "Claudia", "Jean", "Pierre",
    "Michel", "André", "Philippe", "Jacques", "Marie", "Nathalie", "Isabelle", "Catherine", "Sylvie", "José", "Antonio", "Juan", "Francisco", "Manuel",
    "Javier", "Carlos", "Miguel", "María", "Carmen", "Ana", "Isabel", "Dolores", "Pilar", "Teresa",
)
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Drive", "Dr", "Boulevard", "Blvd", "Court", "Ct", "Place", "Pl", "Square", "Terrace", "Way")
WAYS = ("rue", "avenue", "boulevard", "place", "chemin", "allée", "calle", "avenida", "plaza", "paseo", "camino")
COUNTRIES = ("AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE", "IT", "LI", "LU", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK", "TR")
NAMES = {
    "secret": ("password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "access_key", "private_key", "auth", "bearer", "credential", "passwort", "kennwort", "contraseña", "clave", "mot de passe"),
    "local_phone": ("phone", "telephone", "tel", "mobile", "fax", "call", "cell", "whatsapp", "sms", "telefon", "rufnummer", "handy", "téléphone", "portable", "teléfono", "móvil"),
    "spelt_email": ("mail", "e-mail", "email", "contact", "write", "reach", "kontakt", "schreiben", "courriel", "écrire", "correo", "contacto", "escribir"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer", "überweisung", "virement", "transferencia"),
    "identity": ("ssn", "social security", "social", "taxpayer", "tax id", "identity", "id number", "national id"),
    "person": ("name", "named", "signed", "by", "from", "contact", "author", "employee", "patient", "customer", "client", "dear", "namens", "nom", "nombre"),
    "street": ("address", "live at", "lives at", "located at", "ship to", "adresse", "wohnhaft", "dirección", "domicilio", "habite"),
}
PERSON = rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.?\x20\p{{Lu}}\p{{L}}++|(?:{'|'.join(GIVEN)})\x20\p{{Lu}}\p{{L}}++)(?:[\x20-]\p{{Lu}}\p{{L}}++)?(?!\p{{L}})"
STREET = rf"(?<![\p{{L}}0-9])(?:[0-9]{{1,5}}\x20(?:\p{{Lu}}\p{{L}}{{1,30}}\x20){{1,3}}(?:{'|'.join(STREETS)})|[0-9]{{1,4}},?\x20(?:{'|'.join(WAYS)})\x20\p{{Lu}}\p{{L}}{{1,30}}|\p{{Lu}}\p{{L}}{{1,30}}(?:straße|strasse|weg|platz|allee)\x20[0-9]{{1,4}})(?![\p{{L}}0-9])"
WEAK = {"secret": SECRET, "local_phone": LOCAL_PHONE, "spelt_email": SPELT_EMAIL, "iban": IBAN, "identity": IDENTITY, "person": PERSON, "street": STREET}
KINDS = (*BASE, *WEAK)
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, **WEAK}
#: What a text must hold for a pattern to match at all; cheap to look for.
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": "[0-9]", "local_phone": r"[0-9]{3}\D{1,2}[0-9]{3}", "spelt_email": r"at[)\]]",
    "iban": r"[A-Z]{2}[0-9]{2}", "identity": r"[0-9]-[0-9]{2}-[0-9]", "person": rf"\b(?:{'|'.join(TITLES + GIVEN)})\b", "street": rf"[0-9],?\x20(?:\p{{Lu}}|{'|'.join(WAYS)})|(?:straße|strasse|weg|platz|allee)\x20[0-9]",
}
#: Characters before a match that the gazetteer and context labelers see.
BEFORE = 24
EM_ROUNDS = 50
#: Elements that a scan puts together at a time.
BLOCK = 128


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _scan(n: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step(state, k) -> (state, out)`` puts out for k = 0 .. n - 1, as array<kind>.

    Arrays grow by blocks and the blocks by an array of blocks, so that a long
    one isn't copied for each element.
    """
    none = F.array().cast(f"array<{kind}>")

    def add(acc: Column, state: Column, out: Column) -> Column:
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(out)).alias("out"))

    def one(acc: Column, k: Column) -> Column:
        state, out = step(acc["state"], k)
        return add(acc, state, out)

    def block(acc: Column, at: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), none.alias("out"))
        return _let(F.aggregate(F.sequence(at, F.least(at + BLOCK, n) - 1), begin, one), lambda r: add(acc, r["state"], r["out"]))

    begin = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(BLOCK)), begin, block, lambda acc: F.flatten(acc["out"]))).otherwise(none)


def _hits(text: Column, kind: str) -> Column:
    """Leftmost matches: array<struct<gap,size,ok,votes,features>>, with the lengths of each match and of what lies before it.

    What lies between matches and the matches themselves come from the same
    search. Base kinds have their test in ``ok``, others their votes.
    """
    def seen(gap: Column, hit: Column) -> Column:
        before = F.substring(gap, -BEFORE, BEFORE)
        weak = kind in WEAK
        none = F.lit(None).cast("string")
        return F.struct(
            F.length(gap).alias("gap"), F.length(hit).alias("size"), (F.lit(True) if weak else _valid(kind, hit)).alias("ok"),
            (_votes(kind, hit, before) if weak else none).alias("votes"), (_features(hit, before) if weak else none).alias("features"),
        )

    each = F.zip_with(F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), seen)
    none = F.array().cast("array<struct<gap:int,size:int,ok:boolean,votes:string,features:string>>")
    return F.when(text.rlike(HINTS[kind]), F.filter(each, lambda x: x["size"].isNotNull())).otherwise(none)


def _spans(hits: str) -> Column:
    """Places of the matches in a column of hits, without those that failed: array<struct<start,end,votes,features>>."""
    def step(at: Column, k: Column) -> tuple[Column, Column]:
        x = F.get(hits, k)
        end = at + x["gap"] + x["size"]
        return end, end

    ends = _scan(F.size(hits), F.lit(0), step, "int")
    placed = F.zip_with(ends, F.col(hits), lambda e, x: F.struct((e - x["size"]).alias("start"), e.alias("end"), x["votes"].alias("votes"), x["features"].alias("features"), x["ok"].alias("ok")))
    good = F.transform(F.filter(placed, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["votes"].alias("votes"), x["features"].alias("features")))
    return F.when(F.size(hits) > 0, good).otherwise(F.array().cast("array<struct<start:int,end:int,votes:string,features:string>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the checksum: every second one from the right counts double, by digit sum."""
    each = F.transform(
        F.sequence(F.lit(0), F.length(digits) - 1),
        lambda i: (lambda d, twice: F.when(twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d))(
            F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int"), i % 2 == 1
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    """The test of a base kind."""
    digits = _digits(value)
    if kind == "ip":
        octet = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.substring(F.concat(F.lit("000"), F.ltrim(p, F.lit("0"))), -3, 3) <= "255")
        return F.forall(F.split(value, r"\."), octet)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _joined(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))


def _votes(kind: str, value: Column, before: Column) -> Column:
    """Votes of the labelers, a letter each: + yes, - no, 0 abstains.

    regex: the exact shape; gazetteer: a word before the match that names such
    data; context: how the match is introduced; mixture: letters and digits.
    """
    named = F.lower(before).rlike(r"(?:" + "|".join(NAMES[kind]) + r")\W{0,4}$")
    mixed = F.lit("0")
    if kind == "secret":
        shape = value.rlike(r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{18}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|(?:ghp|sk|xox[a-z])[_-][A-Za-z0-9-]{16,})$")
        share = F.length(_digits(value)) / F.length(value)
        mixed = F.when(share.between(0.15, 0.9) & (F.length(value) >= 16), "+").when(value.rlike(r"^[0-9-]+$") | (share < 0.05), "-").otherwise("0")
    elif kind == "local_phone":
        shape = value.rlike(r"^\([0-9]{3}\) |^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$")
    elif kind == "spelt_email":
        shape = value.rlike(r"at[)\]].*dot[)\]]")
    elif kind == "iban":
        shape = F.substring(value, 1, 2).isin(*COUNTRIES)
        mixed = F.when(F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34), "+").otherwise("-")
    elif kind == "identity":
        shape = ~value.rlike(r"^(?:000|666|9)|-00-|-0000$")
    elif kind == "person":
        shape = value.rlike(rf"^(?:{'|'.join(TITLES)})\b")
        mixed = F.when(value.rlike(rf"^(?:(?:{'|'.join(TITLES)})\.?\x20)?(?:{'|'.join(GIVEN)})\b"), "+").otherwise("0")
    else:
        shape = value.rlike(rf"^[0-9].*(?:{'|'.join(STREETS)})$|(?:straße|strasse)")
    context = F.when(before.rlike(r"[=:]\s?[\"']?$"), "+").when(before.rlike(r"[.,/#]$"), "-").otherwise("0")
    return F.concat(F.when(shape, "+").otherwise("-"), F.when(named, "+").otherwise("0"), context, mixed)


def _features(value: Column, before: Column) -> Column:
    """What the span classifier sees: length, characters, and what stands before."""
    return F.concat_ws(
        "|",
        F.least(F.length(value) / 8, F.lit(6)).cast("int").cast("string"),
        value.rlike("[A-Z]").cast("string"),
        value.rlike("[a-z]").cast("string"),
        value.rlike("[g-zG-Z]").cast("string"),
        value.rlike("[^A-Za-z0-9]").cast("string"),
        F.least(F.length(_digits(value)) * 4 / F.length(value), F.lit(3)).cast("int").cast("string"),
        before.rlike(r"[=:]\s?[\"']?$").cast("string"),
    )


def em(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """Posterior of "personal data" for each pattern of votes.

    A two-class model with a rate of +, - and 0 for each labeler and class,
    which start at the majority of the votes.
    """
    if not patterns:
        return {}
    m = len(next(iter(patterns)))
    post = {p: min(0.95, max(0.05, 0.5 + 0.25 * (p.count("+") - p.count("-")))) for p in patterns}
    for _ in range(rounds):
        prior = (sum(post[p] * n for p, n in patterns.items()) + 1) / (sum(patterns.values()) + 2)
        rate = [[{v: 1.0 for v in "+-0"} for _ in range(m)] for _ in range(2)]
        for p, n in patterns.items():
            for j, v in enumerate(p):
                rate[1][j][v] += post[p] * n
                rate[0][j][v] += (1 - post[p]) * n
        for y in range(2):
            for j in range(m):
                total = sum(rate[y][j].values())
                rate[y][j] = {v: x / total for v, x in rate[y][j].items()}
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rate[1][j][v] / rate[0][j][v]) for j, v in enumerate(p))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def fit_classifier(rows: list[tuple[str, float, float]]) -> dict[str, float]:
    """Naive Bayes over feature strings: (features, weight yes, weight no) to the probability of each feature string."""
    yes, no = sum(r[1] for r in rows) + 1, sum(r[2] for r in rows) + 1
    count: dict[tuple[int, str], list[float]] = {}
    for f, a, b in rows:
        for j, v in enumerate(f.split("|")):
            c = count.setdefault((j, v), [0.5, 0.5])
            c[0] += a
            c[1] += b
    out = {}
    for f, _, _ in rows:
        z = math.log(yes / no) + sum(math.log(count[j, v][0] / (yes + 1)) - math.log(count[j, v][1] / (no + 1)) for j, v in enumerate(f.split("|")))
        out[f] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, a struct of base spans, and ``weak``, the spans that the method adds.

    Matches of the wider patterns are candidates. Labelers vote on each; the
    votes are counted over all documents by pattern (at most 3^4 a kind), and
    expectation-maximisation finds how reliable each labeler is. Its posteriors
    train the final span classifier, from counts by feature string (at most
    some hundred). A candidate becomes a span where classifier and posterior
    agree on average; one that overlaps a base span goes, so base spans stay.

    Spans are in code points, end exclusive. Null text counts as empty.
    Repeated rows return repeated rows; ids may be null or repeat. Columns but
    these two are not read, whatever their names. An empty table gives no
    rows. A text of any length is searched once a kind, and places are running
    sums over its matches, whose cost grows with their number. No row is
    shuffled by key.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = stage(docs.select(F.col(id_col).alias("doc_id"), *[_hits(text, k).alias(k) for k in KINDS]), "pii-hits")
    slim = lambda k: F.transform(_spans(k), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    def marked(n: int, kind: str) -> Column:
        return F.transform(_spans(kind), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(n).alias("kind"), x["votes"].alias("votes"), x["features"].alias("features")))

    some = F.lit(False)
    for k in WEAK:
        some = some | (F.size(k) > 0)
    none = F.array().cast("array<struct<start:int,end:int,kind:int,votes:string,features:string>>")
    # spans of all kinds in order, where there is a candidate
    found = stage(hits.select("doc_id", F.struct(*[slim(k).alias(k) for k in BASE]).alias("base"), F.when(some, F.array_sort(F.concat(*[marked(n, k) for n, k in enumerate(KINDS)]))).otherwise(none).alias("all")), "pii-spans")
    n, last = F.size("all"), F.lit(2147483647)

    def after(end: Column, k: Column) -> tuple[Column, Column]:
        x = F.get("all", k)
        return F.when(x["kind"] < len(BASE), F.greatest(end, x["end"])).otherwise(end), x["start"] < end

    def ahead(start: Column, k: Column) -> tuple[Column, Column]:
        x = F.get("all", n - 1 - k)
        return F.when(x["kind"] < len(BASE), x["start"]).otherwise(start), start < x["end"]

    touched = F.zip_with(_scan(n, F.lit(0), after, "boolean"), F.reverse(_scan(n, last, ahead, "boolean")), lambda a, b: a | b)
    free = F.filter(F.zip_with("all", touched, lambda x, t: F.when(~t & (x["kind"] >= len(BASE)), x)), lambda x: x.isNotNull())
    found = found.select("doc_id", "base", F.when(n > 0, free).otherwise(none).alias("free"))
    counted = found.select(F.explode("free").alias("c")).groupBy("c.kind", "c.votes", "c.features").count().collect()
    verdicts = {}
    for k in WEAK:
        cells = [tuple(r)[1:] for r in counted if KINDS[r["kind"]] == k]
        patterns: dict[str, int] = {}
        for v, _, n in cells:
            patterns[v] = patterns.get(v, 0) + n
        post = em(patterns)
        rows: dict[str, list[float]] = {}
        for v, f, n in cells:
            r = rows.setdefault(f, [0.0, 0.0])
            r[0] += post[v] * n
            r[1] += (1 - post[v]) * n
        score = fit_classifier([(f, *r) for f, r in rows.items()])
        verdicts[k] = sorted((v, f) for v, f, _ in cells if post[v] + score[f] >= 1)

    def accepted(kind: str) -> Column:
        if not verdicts[kind]:
            return F.array().cast("array<struct<start:int,end:int>>")
        good = F.array(*[F.lit(f"{v} {f}") for v, f in verdicts[kind]])
        yes = F.filter("free", lambda x: (x["kind"] == KINDS.index(kind)) & F.array_contains(good, F.concat_ws(" ", x["votes"], x["features"])))
        return F.transform(yes, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    return found.select(F.col("doc_id").alias(id_col), "base", F.struct(*[accepted(k).alias(k) for k in WEAK]).alias("weak"))


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    base = F.array_join(F.concat(*[_joined(F.col(f"base.{k}"), k) for k in BASE]), ",")
    every = F.array_join(F.concat(*[_joined(F.col(f"base.{k}"), k) for k in BASE], *[_joined(F.col(f"weak.{k}"), k) for k in WEAK]), ",")
    return found.select(
        "doc_id",
        *[F.size(f"base.{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(base, 256).alias("base_sha256"),
        every.alias("spans"),
    )
