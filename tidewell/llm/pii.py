"""Personal data and secrets: overlapping candidates, boosted trees, calibrated thresholds; SQL functions alone.

*Base spans* (email, ip, card, phone) come from fixed patterns and checks. *Candidates* come from generators
of high recall, of any length, may overlap, and get features of format (length, digits, letter case, different
characters, runs of figures) and of context (key words before, an assignment, quotes). Trees are boosted on all
documents at once: features have few values, so a count of candidates by features and label is all that fitting
needs, whatever the number of documents.

*Labels.* There are none, so candidates of the corpus have weak ones from what features don't show or show in part:
check digits (Luhn, IBAN), forms of known issuers (AKIA..., ghp_..., JSON web tokens), area rules, usual key lengths,
and a secret's key word given a value. Beside them stand generated examples (``examples``), right ones in many forms and with and
without key words, and wrong ones such as dates, versions and part numbers, as a tenth of all. So the trees score also what no check
knows, by its format and context. A fifth of the documents and examples sets for each generator the threshold from which the share of label 1
is at least PRECISION.

Selected candidates that overlap a base span give way to it; those that overlap each other are one span.

Nulls: a null or empty text has no spans. Rows with equal ids are judged each by its text. Columns besides
doc_id and text are ignored. Positions count code points; ends are exclusive. A text of n matches takes n * sqrt(n) steps.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log
from random import Random
from string import ascii_letters, ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

# The base patterns. A match begins where none of the same run could begin before it:
# looking back keeps long runs linear, and groups that never give back (++) keep the stack flat. After an email the next may begin within a run (\G).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
KINDS = ("email", "ip", "card", "phone")

#: Generators of candidates: a value given to a key, letters and digits mixed, figures with signs between, parts with dots
#: between, account numbers, and blocks of keys. Their groups never give back, so any length is linear.
GENERATORS = (
    ("secret", r"(?<![A-Za-z_])[A-Za-z_]++ {0,3}[=:] {0,3}[\"']?[A-Za-z0-9+/_.=~!@#$%^&*-]{6,}+[\"']?"),
    ("secret", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+"),
    ("number", r"(?<![0-9A-Za-z])[0-9](?:[ .()-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])"),
    ("secret", r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]{8,}+){2,}+"),
    ("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("secret", r"-----BEGIN [A-Z ]*+-----[A-Za-z0-9+/=\s]*+-----END [A-Z ]*+-----"),
)
FEATURES = ("gen", "length", "digits", "upper", "lower", "hex", "distinct", "runs", "words", "starts", "key", "assigned", "quoted", "signs", "plus")
DEPTH, ROUNDS, RATE, PRECISION = 3, 40, 0.3, 0.9
#: Key words: of secrets, of telephones, of persons' and accounts' numbers.
SECRET_KEY = r"pass|pwd|token|secret|api.?key|access.?key|private|credential|auth|bearer|session"
PHONE_KEY = r"phone|tel|mobile|call|fax|cell"
PERSON_KEY = r"ssn|social|iban|account|passport|licen[cs]e no|tax.?id|insurance"
#: Forms of keys by their issuers.
ISSUED = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|glpat-[A-Za-z0-9_-]{20,}|sk[-_](?:live_|test_|proj-)?[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"
#: Characters of keys and digests in hexadecimal.
HEX = r"^(?:[0-9a-fA-F]{16}|[0-9a-fA-F]{18}|[0-9a-fA-F]{20}|[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64}|[0-9a-fA-F]{128})$"
#: Figures of social security numbers that are given out.
SSN = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"

SPANS = "array<struct<s:int,e:int,v:string,b:string>>"
MERGED = "array<struct<s:int,k:int,e:int,kind:string>>"


def running(values: Column, step) -> Column:
    """The fold of ``values`` by ``step``, whose zero is 0, up to and with each.

    Blocks of about the square root of their number are folded by themselves: appending copies what is there.
    """
    zero = F.array(F.lit(0))
    fold = lambda block, start: F.aggregate(block, start, lambda a, x: F.array_append(a, step(F.element_at(a, -1), x)))

    def blocked(v: Column, size: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), ((F.size(v) - 1) / size).cast("int")), lambda b: F.slice(v, b * size + 1, size))

        def joined(blocks: Column) -> Column:
            before = fold(F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), step)), zero)
            return F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), lambda block, start: F.slice(fold(block, F.array(start)), 2, F.size(block))))

        return let(blocks, joined)

    size = lambda v: F.greatest(F.lit(32), F.sqrt(F.size(v)).cast("int"))
    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).when(F.size(v) <= 32, F.slice(fold(v, zero), 2, F.size(v))).otherwise(let(size(v), lambda n: blocked(v, n))))


def spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, v, b>> of the leftmost matches that don't overlap; b: the last 20 characters between it and the one before."""

    def placed(pieces: Column, found: Column) -> Column:
        lengths = F.transform(found, lambda m, i: F.length(F.get(pieces, i)) + F.length(m))
        row = lambda m, i, ends: F.struct((F.get(ends, i) - F.length(m)).alias("s"), F.get(ends, i).alias("e"), m.alias("v"), F.right(F.get(pieces, i), F.lit(20)).alias("b"))
        return let(running(lengths, lambda a, x: a + x), lambda ends: F.transform(found, lambda m, i: row(m, i, ends)))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(SPANS)).otherwise(let(F.split(text, pattern, -1), lambda pieces: placed(pieces, m))))


def luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(c.cast("int") * (1 + i % 2), lambda d: d - F.when(d > 9, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def iban(v: Column) -> Column:
    """Whether the check digits of an account number are right: letters as 10 to 35, the first four characters last, modulo 97."""
    plain = F.replace(v, F.lit(" "), F.lit(""))
    codes = F.transform(F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), ""), lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).when(c.rlike("[0-9]"), c.cast("int")))
    return F.aggregate(codes, F.lit(0), lambda a, x: F.coalesce((a * F.when(x > 9, 100).otherwise(10) + x) % 97, a)) == 1


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _valid(kind: str):
    if kind == "ip":
        return lambda x: x["v"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return lambda x: F.length(_digits(x["v"])).between(12, 19) & luhn(_digits(x["v"]))
    if kind == "phone":
        return lambda x: F.length(_digits(x["v"])).between(9, 15)
    return lambda x: F.lit(True)


def _none() -> Column:
    return F.array().cast(SPANS)


def base_spans(text: Column, has_digit: Column) -> dict[str, Column]:
    out = {"email": F.when(F.contains(text, F.lit("@")), spans(text, EMAIL)).otherwise(_none())}
    for kind, pattern, needed in (("ip", IP, None), ("card", CARD, None), ("phone", PHONE, "+")):
        here = has_digit if needed is None else has_digit & F.contains(text, F.lit(needed))
        out[kind] = F.when(here, F.filter(spans(text, pattern), _valid(kind))).otherwise(_none())
    return out


def _bucket(value: Column, edges: tuple[int, ...]) -> Column:
    out = F.lit(len(edges))
    for i, e in reversed(list(enumerate(edges))):
        out = F.when(value < e, i).otherwise(out)
    return out


def _candidate(x: Column, gen: int) -> Column:
    """A candidate with its features, each a small whole number, and its weak label."""
    v, before = x["v"], x["b"]
    value = F.regexp_replace(v, r"^[A-Za-z_]++ {0,3}[=:] {0,3}", "") if gen == 0 else v
    value = F.regexp_replace(value, "[\"']", "")
    key = F.lower(F.concat(before, F.lit(" "), F.regexp_extract(v, "^[A-Za-z_]+", 0) if gen == 0 else F.lit("")))
    return let(F.struct(value.alias("value"), key.alias("key"), _digits(value).alias("figures")), lambda o: _described(x, gen, v, before, o["value"], o["key"], o["figures"]))


def _described(x: Column, gen: int, v: Column, before: Column, value: Column, key: Column, figures: Column) -> Column:
    flag = lambda c: c.cast("int")
    share = F.length(figures) * 100 / F.greatest(F.length(value), F.lit(1))
    distinct = F.size(F.array_distinct(F.split(value, "")))
    assigned = F.lit(True) if gen == 0 else before.rlike("[=:] {0,3}[\"']?$")
    kind = F.when(key.rlike(SECRET_KEY), 3).when(key.rlike(PERSON_KEY), 2).when(key.rlike(PHONE_KEY), 1).otherwise(0)
    plus = before.rlike(r"\+\s?\(?$")
    n = F.length(figures)
    if gen == 2:
        label = luhn(figures) & n.between(12, 19) | n.between(9, 15) & (plus | (kind == 1)) | value.rlike(SSN) & ((kind == 2) | ~before.rlike("[0-9A-Za-z]$"))
    elif gen == 4:
        label = iban(value)
    elif gen == 5:
        label = value.rlike("PRIVATE KEY")
    else:
        label = value.rlike(ISSUED) | value.rlike(HEX) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") | (kind == 3) & assigned & value.rlike("[0-9]") & (distinct >= 6)
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lit(gen).alias("gen"),
        _bucket(F.length(value), (9, 13, 17, 25, 41, 81)).alias("length"), _bucket(share, (1, 20, 45, 70, 100)).alias("digits"),
        flag(value.rlike("[A-Z]")).alias("upper"), flag(value.rlike("[g-z]")).alias("lower"), flag(value.rlike("^[0-9a-fA-F]+$")).alias("hex"),
        _bucket(distinct, (6, 9, 13, 18)).alias("distinct"), _bucket(F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))), (2, 3, 4, 7)).alias("runs"),
        _bucket(F.size(F.regexp_extract_all(value, F.lit("[a-z]{4,}"), F.lit(0))), (1, 2, 3)).alias("words"),
        flag(value.rlike("^(?:[A-Z]{4}[A-Z0-9]|[A-Za-z]{2,6}[_-])")).alias("starts"), kind.alias("key"), flag(assigned).alias("assigned"),
        flag(v.rlike("[\"']$")).alias("quoted"), flag(value.rlike("[ ()./-]")).alias("signs"), flag(plus).alias("plus"),
        F.coalesce(label, F.lit(False)).alias("label"),
    )


def candidates(text: Column, has_digit: Column) -> Column:
    of = lambda gen: lambda x: _candidate(x, gen)
    found = [F.transform(spans(text, pattern), of(g)) for g, (_, pattern) in enumerate(GENERATORS)]
    return F.when(has_digit, F.concat(*found))


@dataclass(frozen=True)
class Model:
    """Trees as nested ((feature, value), yes, no), leaves as numbers; thresholds by generator."""

    start: float
    trees: tuple
    thresholds: tuple

    def sql(self) -> str:
        return " + ".join([repr(self.start), *map(_tree_sql, self.trees)])


def _tree_sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    (feature, value), yes, no = tree
    return f"(CASE WHEN {feature} <= {value} THEN {_tree_sql(yes)} ELSE {_tree_sql(no)} END)"


def _tree_value(tree, row: dict) -> float:
    while not isinstance(tree, float):
        (feature, value), yes, no = tree
        tree = yes if row[feature] <= value else no
    return tree


def _grow(rows: list[tuple[dict, float, float]], depth: int):
    """The tree of Newton steps for rows (features, gradient, curvature)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    gain = lambda g, h: g * g / (h + 1.0)
    best = (1e-6, None)
    if depth:
        for f in FEATURES:
            sums: dict = {}
            for row, a, b in rows:
                s = sums.setdefault(row[f], [0.0, 0.0])
                s[0] += a
                s[1] += b
            a = b = 0.0
            for value in sorted(sums)[:-1]:
                a, b = a + sums[value][0], b + sums[value][1]
                best = max(best, (gain(a, b) + gain(g - a, h - b) - gain(g, h), (f, value)), key=lambda x: x[0])
    if best[1] is None:
        return RATE * g / (h + 1.0)
    f, value = best[1]
    return best[1], _grow([r for r in rows if r[0][f] <= value], depth - 1), _grow([r for r in rows if r[0][f] > value], depth - 1)


def fit(counts: list[tuple[dict, int, int, int, int]]) -> Model:
    """From (features, fitted 0s, fitted 1s, held-out 0s, held-out 1s), a row for each combination of values."""
    zeros, ones = sum(c[1] for c in counts), sum(c[2] for c in counts)
    start = log((ones + 1) / (zeros + 1))
    scores, trees = [start] * len(counts), []
    for _ in range(ROUNDS if zeros and ones else 0):
        rows = []
        for (row, n0, n1, _, _), s in zip(counts, scores):
            p = 1 / (1 + exp(-max(-30.0, min(30.0, s))))
            rows.append((row, n1 - (n0 + n1) * p, (n0 + n1) * p * (1 - p)))
        trees.append(_grow(rows, DEPTH))
        scores = [s + _tree_value(trees[-1], c[0]) for s, c in zip(scores, counts)]
    thresholds = []
    for gen in range(len(GENERATORS)):
        # The lowest score, of even odds at least, down to which every level of held-out candidates has the
        # precision; where too few of a level are held out, the fitted ones tell.
        levels: dict = {}
        for s, c in zip(scores, counts):
            if c[0]["gen"] == gen and s > 0:
                levels.setdefault(s, []).append(c)
        best = 1e9
        for s in sorted(levels, reverse=True):
            n0, n1 = sum(c[3] for c in levels[s]), sum(c[4] for c in levels[s])
            if n0 + n1 < 5:
                n0, n1 = n0 + sum(c[1] for c in levels[s]), n1 + sum(c[2] for c in levels[s])
            if n1 < PRECISION * (n0 + n1):
                break
            best = s - 1e-9
        thresholds.append(best)
    return Model(start, tuple(trees), tuple(thresholds))


#: Examples of each form that are generated, and their share of all that is fitted, one in so many.
EXAMPLES, ONE_IN = 60, 10


def examples() -> list[tuple[str, bool]]:
    """Generated texts with one candidate or more, and whether it is personal or secret: the same ones each time."""
    r = Random(1)
    some = lambda letters, least, most=None: "".join(r.choices(letters, k=r.randint(least, most or least)))
    word = lambda: some(ascii_lowercase, 3, 9)
    hexadecimal, mixed = digits + "abcdef", ascii_letters + digits
    secret_key = lambda: r.choice(["password", "passwd", "pwd", "api_key", "apikey", "secret", "token", "access_token", "auth", "client_secret", "PASSWORD", "API_KEY", "session_token"])
    other_key = lambda: r.choice(["version", "page", "part_no", "date", "time", "build", "path", "file", "size", "color", "ratio", "see", "note", "isbn", "port", "level"])
    gives = lambda key, value: key + r.choice(["=", ": ", " = ", ":"]) + r.choice(["{}", '"{}"', "'{}'"]).format(value)
    secrets = (
        lambda: some(hexadecimal, r.choice([16, 18, 20, 32, 40, 64])), lambda: some(mixed, 12, 64), lambda: some(mixed + "+/", 20, 88), lambda: some(mixed + "!@#$%^&*", 8, 20),
        lambda: "AKIA" + some(ascii_uppercase + digits, 16), lambda: r.choice(["ghp_", "gho_"]) + some(mixed, 36), lambda: "sk-" + some(mixed, 32, 48), lambda: "eyJ" + some(mixed, 17, 40) + ".eyJ" + some(mixed, 30, 120) + "." + some(mixed + "-_", 43),
    )
    plain = (
        lambda: f"{r.randint(1, 12)}.{r.randint(0, 30)}.{r.randint(0, 9)}-{word()}", lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"{r.randint(1900, 2030)}{r.randint(1, 12):02}{r.randint(1, 28):02}",
        lambda: f"{word()}-{word()}-{r.randint(1, 99)}", lambda: f"{word()}/{word()}/{word()}{r.randint(1, 99)}", lambda: f"{word()}{r.randint(1, 99)}/{word()}-{r.randint(1, 9)}/{word()}_{r.randint(1, 99)}", lambda: f"{r.randint(1, 999)}-{some(digits, 3)}-{some(digits, 3)}", lambda: f"{word()}_{word()}_{r.randint(1, 2030)}",
        lambda: " ".join(str(r.randint(100, 999)) for _ in range(3)), lambda: f"{r.randint(1990, 2030)}-{r.randint(1990, 2030)}", lambda: some(digits, 7, 16), lambda: f"{word().upper()}-{word().upper()}-{r.randint(1, 9)}", lambda: f"{r.randint(0, 23):02}.{r.randint(0, 59):02}.{r.randint(1900, 2030)}",
    )

    def account() -> str:
        country, rest = some(ascii_uppercase, 2), some(digits, 16)
        number = "".join(str(int(c, 36)) for c in rest + country + "00")
        return f"{country}{98 - int(number) % 97:02}{rest}"

    out = []
    for _ in range(EXAMPLES):
        out += [(gives(secret_key(), f()), True) for f in secrets]
        out += [(f"{word()} {f()} {word()}", True) for f in (secrets[0], *secrets[4:])]
        out += [(f"{word()} {account()} {word()}", True), (f"-----BEGIN RSA PRIVATE KEY-----\n{some(mixed, 64)}\n{some(mixed, 64)}\n-----END RSA PRIVATE KEY-----", True)]
        out += [(f"{r.choice(['ssn', 'SSN:', 'social security number'])} {r.randint(100, 665)}-{r.randint(1, 99):02}-{r.randint(1, 9999):04}", True)]
        out += [(f"{r.choice(['phone', 'tel.', 'call', 'mobile:'])} {r.choice(['({}) {}-{}', '{}-{}-{}', '{} {} {}']).format(some(digits, 3), some(digits, 3), some(digits, 4))}", True)]
        out += [(f"{word()} {f()} {word()}", False) for f in plain] + [(gives(other_key(), f()), False) for f in plain]
        out += [(gives(r.choice([secret_key(), other_key()]), word() + word()[:3]), False), (f"{word()} {some(ascii_uppercase, 2)}{some(digits, 2)} {some(ascii_uppercase + digits, 4)} {some(ascii_uppercase + digits, 4)}", False)]
    return out


def _counted(docs: DataFrame, label: Column) -> list:
    """A row for each combination of features: f, and how many candidates are fitted and held out with each ``label``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("*", F.explode(candidates(text, text.rlike("[0-9]"))).alias("c")).select((F.abs(F.xxhash64("doc_id")) % 5 == 0).alias("held"), label.alias("label"), "c")
    n = lambda held, label: F.count_if((F.col("held") == held) & (F.col("label") == label))
    counts = rows.groupBy(*(F.col(f"c.{f}").alias(f) for f in FEATURES)).agg(n(False, False).alias("a"), n(False, True).alias("b"), n(True, False).alias("c0"), n(True, True).alias("d"))
    # At most one row for each combination of the features' few values, however many candidates there are.
    return counts.collect()


def train(docs: DataFrame) -> Model:
    made = docs.sparkSession.createDataFrame([(i, t, y) for i, (t, y) in enumerate(examples())], "doc_id long, text string, y boolean")
    corpus, own = _counted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), F.col("c.label")), _counted(made, F.col("y"))
    total = lambda rows: sum(r.a + r.b + r.c0 + r.d for r in rows)
    weight = max(1, total(corpus) // ((ONE_IN - 1) * total(own)))
    sums: dict = {}
    for rows, times in ((corpus, 1), (own, weight)):
        for r in rows:
            have = sums.setdefault(tuple(r[f] for f in FEATURES), [0, 0, 0, 0])
            for i, n in enumerate((r.a, r.b, r.c0, r.d)):
                have[i] += n * times
    return fit([(dict(zip(FEATURES, k)), *n) for k, n in sorted(sums.items())])


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _merged(found: Column) -> Column:
    """Spans that overlap as one, which has the first one's kind; ``found`` is sorted by start."""

    def joined(x: Column, upto: Column) -> Column:
        first = F.filter(F.transform(x, lambda v, i: F.when((i == 0) | (v["s"] >= F.get(upto, i - 1)), i)), lambda i: i.isNotNull())
        one = lambda p, j, at: F.struct(F.get(x, p)["s"].alias("s"), F.get(x, p)["k"].alias("k"), F.get(upto, F.coalesce(F.get(at, j + 1), F.size(x)) - 1).alias("e"), F.get(x, p)["kind"].alias("kind"))
        return let(first, lambda at: F.transform(at, lambda p, j: one(p, j, at)))

    return let(found, lambda x: let(running(F.transform(x, lambda v: v["e"]), lambda a, e: F.greatest(a, e)), lambda upto: joined(x, upto)))


def _free(picked: Column, base: Column) -> Column:
    """Those of ``picked`` that overlap none of ``base``: none that starts before ends later, none that starts later starts within."""
    far = (1 << 31) - 1

    def judged(x: Column, before: Column, after: Column) -> Column:
        open_ = lambda v, i: (v["k"] >= len(KINDS)) & (F.get(before, i) <= v["s"]) & (far - F.get(after, F.size(x) - 1 - i) >= v["e"])
        return F.filter(F.transform(x, lambda v, i: F.when(open_(v, i), v)), lambda v: v.isNotNull())

    def scanned(x: Column) -> Column:
        mine = lambda v: v["k"] < len(KINDS)
        most = lambda a, e: F.greatest(a, e)
        ends = F.transform(x, lambda v: F.when(mine(v), v["e"]).otherwise(0))
        starts = F.transform(F.reverse(x), lambda v: F.when(mine(v), F.lit(far) - v["s"]).otherwise(0))
        return let(running(ends, most), lambda before: let(running(starts, most), lambda after: judged(x, before, after)))

    # Of spans that start together the base ones come first, and so count as before.
    return let(F.sort_array(F.concat(base, picked)), scanned)


def detected(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the counts of base spans, ``base`` and ``spans`` (arrays of s, k, e, kind in order)."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), text.rlike("[0-9]").alias("has_digit"))
    found = base_spans(F.col("text"), F.col("has_digit"))
    rows = docs.select("doc_id", *(found[k].alias(k) for k in KINDS), candidates(F.col("text"), F.col("has_digit")).alias("c"))
    kinded = lambda kind, k: F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lit(KINDS[k]).alias("kind")))
    base = F.sort_array(F.concat(*(kinded(F.col(k), i) for i, k in enumerate(KINDS))))
    rows = rows.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), base.alias("base"), "c")
    score = F.expr(f"transform(c, x -> {_on(model.sql(), 'x')})")
    limit = F.array(*(F.lit(t) for t in model.thresholds))
    kinds = F.array(*(F.lit(k) for k, _ in GENERATORS))

    picked = F.zip_with("c", score, lambda x, s: F.when(s >= F.get(limit, x["gen"]), F.struct(x["s"].alias("s"), (x["gen"] + len(KINDS)).alias("k"), x["e"].alias("e"), F.get(kinds, x["gen"]).alias("kind"))))
    own = F.filter(picked, lambda x: x.isNotNull())
    more = F.when(F.size("c") > 0, let(own, lambda x: F.when(F.size(x) > 0, _merged(_free(x, F.col("base")))).otherwise(F.array().cast(MERGED)))).otherwise(F.array().cast(MERGED))
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), "base", F.sort_array(F.concat("base", more)).alias("spans"))


def _on(sql: str, name: str) -> str:
    for f in FEATURES:
        sql = sql.replace(f"WHEN {f} ", f"WHEN {name}.{f} ")
    return sql


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = detected(docs, train(docs))
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
