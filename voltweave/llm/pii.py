"""Finding personal data: exact rules, and candidates scored by boosted trees.

The rules (email, ip, card, phone) always count. Beyond them, generators with high recall propose spans that may overlap: addresses
written with (at) and (dot), numbers in the shapes of phones and cards, addresses of hosts, and keys and passwords (kind secret, which has
no rule). Gradient-boosted trees score each proposal by its format and its context; a threshold per kind, calibrated on rows the trees
haven't seen, decides. The trees learn from TRAINING made-up rows, of every kind both data and look-alikes (fingerprints, dates, order
numbers, commit hashes, names of variables), so the model is the same for every corpus, and it is compiled into one expression: the
search is a projection, without a join or a shuffle.

Positions are in code points, ends exclusive.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The rules' kinds and the one that only the trees find.
ALL = (*KINDS, "secret")
TRAINING = 4096
ROUNDS, LEVELS = 16, 4
PRECISION = 0.995
#: Matches whose positions are summed up together; keeps texts with very many matches linear enough.
BLOCK = 256
CONTEXT = 24

# The rules, written so that no text makes them backtrack: runs are possessive, and a match starts only where a run does.
_RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GENERATORS = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[{] ?(?:at|AT) ?[)\]}] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[(\[{] ?(?:dot|DOT) ?[)\]}]) ?[A-Za-z0-9-]{1,63}+){1,4}+",),
    "ip": (r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}+(?![0-9A-Za-z:])", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}+::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}+(?![0-9A-Za-z:])"),
    "card": (r"(?<![0-9A-Za-z])[0-9]{4}(?:[. /-][0-9]{4}){3}(?![0-9A-Za-z])", r"(?<![0-9A-Za-z])3[47][0-9]{2}[. /-]?[0-9]{6}[. /-]?[0-9]{5}(?![0-9A-Za-z])"),
    "phone": (r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])", r"(?<![0-9A-Za-z+])00[0-9]{1,3}[ -](?:[0-9]{2,4}[ -]){1,3}[0-9]{2,4}(?![0-9A-Za-z])"),
    # A run of letters and digits, both of them; what is assigned to a password's name.
    "secret": (
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{12,}+",
        r"(?<=[=:\x20\x22'])(?<=(?:password|passwd|passphrase|pwd|secret|token|api_?key|PASSWORD|SECRET|TOKEN|API_?KEY)[\x22']?\x20?[=:]\x20?[\x22']?)[^\s\x22'<>,;=:]{6,}+",
    ),
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CUES = {"email": "mail|contact|write|reach", "ip": "ip|host|server|address|ping", "card": "card|visa|credit|payment|master", "phone": "phone|tel|call|mobile|cell|fax|whatsapp|reach", "secret": "pass(?:word|wd|phrase)?|pwd|secret|token|key|credentials?|bearer|auth"}
_OTHER = "order|version|isbn|invoice|sku|ref|serial|part|page|date|ticket|token|sha|commit|total|price"


_SPAN = "struct<start:int,end:int,hit:string,before:string,after:string>"


def _with_found(df: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """For each name, (pattern, whether a text is worth searching): the pattern's matches in _pii_text as array<_SPAN>.

    One projection a step: what several expressions read must be a column, or it is worked out once for each of them.
    """
    names, text = list(patterns), F.col("_pii_text")
    none = F.array().cast("array<string>")
    df = df.withColumns({f"{n}_hits": F.when(worth, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) for n, (p, worth) in patterns.items()})
    df = df.withColumns({f"{n}_gaps": F.when(F.size(f"{n}_hits") > 0, F.split(text, patterns[n][0], -1)).otherwise(none) for n in names})
    df = df.withColumns({f"{n}_blocks": _blocks(F.col(f"{n}_hits"), F.col(f"{n}_gaps")) for n in names})
    df = df.withColumns({f"{n}_starts": F.aggregate(f"{n}_blocks", F.array(F.lit(0)), lambda a, block: F.concat(a, F.array(F.element_at(a, -1) + _length(block)))) for n in names})
    return df.withColumns({n: F.flatten(F.zip_with(f"{n}_blocks", F.slice(f"{n}_starts", 1, F.size(f"{n}_blocks")), _positions)) for n in names})


def _blocks(hits: Column, gaps: Column) -> Column:
    """Matches with the text before and after, BLOCK to an array."""

    def block(i: Column) -> Column:
        part = lambda x, skip: F.slice(x, i * BLOCK + 1 + skip, F.least(F.lit(BLOCK), F.size(hits) - i * BLOCK))
        beside = F.zip_with(part(gaps, 0), part(gaps, 1), lambda g, n: F.struct(g.alias("g"), n.alias("n")))
        return F.zip_with(beside, part(hits, 0), lambda p, h: F.struct(p["g"].alias("g"), p["n"].alias("n"), h.alias("h")))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int")), block)
    return F.when(F.size(hits) > 0, blocks).otherwise(F.array().cast("array<array<struct<g:string,n:string,h:string>>>"))


def _length(block: Column) -> Column:
    return F.aggregate(block, F.lit(0), lambda s, p: s + F.length(p["g"]) + F.length(p["h"]))


def _positions(block: Column, start: Column) -> Column:
    zero = F.struct(start.alias("pos"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        at = a["pos"] + F.length(p["g"])
        end = at + F.length(p["h"])
        new = F.struct(at.alias("start"), end.alias("end"), p["h"].alias("hit"), F.right(p["g"], F.lit(CONTEXT)).alias("before"), F.left(p["n"], F.lit(CONTEXT)).alias("after"))
        return F.struct(end.alias("pos"), F.concat(a["spans"], F.array(new)).alias("spans"))

    return F.aggregate(block, zero, step, lambda a: a["spans"])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    return {
        "email": F.lit(True),
        "ip": hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": F.when(n.between(16, 19), _luhn(_digits(hit))).otherwise(F.lit(False)),
        "phone": n.between(8, 15),
    }[kind]


def _features(kind: Column, hit: Column, before: Column, after: Column) -> list[Column]:
    """Numbers that the trees split on: what the span looks like, then what stands beside it."""
    count = lambda chars: F.regexp_count(hit, F.lit(chars))
    d = _digits(hit)
    cue = F.lit(False)
    for k, words in _CUES.items():
        cue = cue | ((kind == k) & F.lower(before).rlike(rf"(?<![a-z])(?:{words})(?![a-z])[^0-9]*$"))
    flags = [hit.rlike(r"^\(?[0-9]{3}\)?[ .-]+[0-9]{3}[ .-][0-9]{4}$"), hit.rlike(r"^(?:19|20)[0-9]{2}[ ./-]|[ ./-](?:19|20)[0-9]{2}$"), (kind == "card") & _luhn(d), cue, F.lower(before).rlike(rf"\b(?:{_OTHER})\b[^0-9]*$"), before.rlike(r"[0-9A-Za-z=#/_-]$"), after.rlike(r"^[0-9A-Za-z=#/_-]")]
    flags += [hit.rlike(r"^[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2})+$"), F.contains(hit, F.lit("::")), hit.rlike(r"(?<![a-z])(?:com|org|net|edu|gov|info|[a-z]{2})$"), hit.rlike("^[0-9A-Fa-f]+$"), hit.rlike("^[A-Z]{2,5}[0-9A-Z]{12,}$")]
    numbers = [F.array_position(F.array(*[F.lit(k) for k in ALL]), kind), F.length(hit), F.length(d), count("[A-Za-z]"), count(r"[ ]"), count(r"[.]"), count(r"[-]"), count(r"[()]"), count("/"), count(":"), F.size(F.array_distinct(F.split(d, "")))]
    numbers += [count("[A-Z]"), count("_"), count("[A-Za-z][0-9]"), F.size(F.array_distinct(F.split(hit, "")))]
    return [x.cast("double") for x in (*numbers, *flags)]


def training_rows(spark: SparkSession, n: int = TRAINING) -> DataFrame:
    """Made-up spans (kind, hit, before, after, label, part): personal data in many formats, and numbers that only look like it."""

    def pick(salt: int, *options) -> Column:
        return F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(options))) + 1).cast("int"))

    def number(salt: int, digits: int) -> Column:
        return F.lpad(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10**digits)).cast("string"), digits, "0")

    def checked(salt: int) -> Column:
        """16 digits in four groups that pass Luhn's test."""
        body = F.concat(F.lit("4"), number(salt, 14))
        right = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(body, c.cast("string"))), _luhn)
        return F.regexp_replace(right[0], "^(.{4})(.{4})(.{4})(.{4})$", "$1/$2/$3/$4")

    def short(salt: int, below: int, width: int = 1) -> Column:
        return F.lpad(F.lower(F.hex(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(below)))), width, "0") if width > 1 else F.lower(F.hex(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(below))))

    def digest(salt: int) -> Column:
        return F.sha2(F.concat_ws("-", "id", F.lit(salt)).cast("binary"), 256)

    length = F.pmod(F.xxhash64("id", F.lit(39)), F.lit(40)).cast("int")
    sep, slash = pick(1, " ", "-", "."), pick(2, "/", ".", "-", " ")
    # Of each kind what is meant, and what only looks like it.
    mail = F.concat(pick(6, "ann", "j.smith", "sales", "q77"), pick(7, " (at) ", "[at]", " [at] ", "(at)"), pick(8, "example", "mail", "uni", "web-mail"), pick(9, " (dot) ", ".", "[dot]"), pick(10, "org", "com", "net", "de", "edu"))
    no_mail = F.concat(pick(6, "look", "row", "x", "meet"), pick(7, " (at) ", "[at]", " [at] ", "(at)"), pick(8, "figure", "noon", "index", "page"), pick(9, " (dot) ", ".", "[dot]"), pick(10, "one", "size", "length", "sharp", "next"))
    groups = F.concat_ws(":", *[short(20 + i, 65536) for i in range(8)])
    squeezed = F.concat(pick(28, "2001", "fe80", "2a02", "fd00"), F.lit(":"), short(20, 65536), F.lit("::"), F.concat_ws(":", *[short(21 + i, 65536) for i in range(2)]))
    pairs = F.concat_ws(":", *[short(20 + i, 256, 2) for i in range(8)])
    scope = F.concat(pick(20, "add", "face", "cafe", "dead", "be", "a", "12"), F.lit("::"), pick(21, "bad", "beef", "dad", "fee", "c", "30"))
    card = F.regexp_replace(checked(31), "/", slash)
    amex = F.concat(F.lit("37"), number(32, 12))
    amex = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(amex, c.cast("string"))), _luhn)[0]
    four = F.concat_ws("-", *[number(40 + i, 4) for i in range(4)])
    phone = pick(2, F.concat(F.lit("("), number(3, 3), F.lit(") "), number(4, 3), F.lit("-"), number(5, 4)), F.concat(number(3, 3), sep, number(4, 3), sep, number(5, 4)), F.concat(F.lit("00"), number(3, 2), F.lit(" "), number(4, 3), F.lit(" "), number(5, 4)))
    dates = pick(11, F.concat(F.lit("20"), number(12, 2), F.lit("-0"), number(13, 2), F.lit("-"), number(14, 3)), F.concat(number(12, 2), F.lit("."), number(13, 3), F.lit("."), F.lit("20"), number(14, 2)))
    base36 = F.upper(F.concat(*[F.conv(F.pmod(F.xxhash64("id", F.lit(50 + i)), F.lit(36**8)).cast("string"), 10, 36) for i in range(3)]))
    key = F.concat(pick(53, "AKIA", "ASIA", "AIZA", "LTAI"), F.substr(base36, F.lit(1), F.lit(16)))
    mixed = F.concat(pick(54, "", "sk-", "ghp_", "xoxb-"), F.substr(F.translate(F.base64(F.unhex(digest(55))), "+/=", "x7"), F.lit(1), F.lit(18) + length % 24))
    hexes = F.substr(digest(56), F.lit(1), F.lit(16) + length)
    phrase = F.concat(pick(57, "hunter", "Correct", "s3same!", "dragon"), number(58, 3), pick(59, "!", "", "x", "#Q"))
    uuid = F.concat_ws("-", *[F.substr(digest(60), F.lit(a), F.lit(w)) for a, w in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    name = F.concat(pick(61, "my_variable_", "figure-number-", "chapter_title_", "layer-weights-"), number(62, 2))
    code = F.concat(pick(63, "SKU-", "ISBN-", "RFC-", "model-"), number(64, 4), F.lit("-"), pick(65, "AB", "XL-2", "rev-3"), number(66, 4))

    kind = F.element_at(F.array(*[F.lit(k) for k in ALL]), (F.col("id") % len(ALL) + 1).cast("int"))
    meant, form = F.pmod(F.xxhash64("id", F.lit(30)), F.lit(2)) == 0, F.pmod(F.xxhash64("id", F.lit(29)), F.lit(4))
    beside = F.pmod(F.xxhash64("id", F.lit(36)), F.lit(10))
    hits = {
        "email": (mail, no_mail),
        "ip": (F.when(form < 2, groups).otherwise(squeezed), F.when(form < 2, pairs).otherwise(scope)),
        "card": (F.when(form < 3, card).otherwise(amex), four),
        "phone": (phone, dates),
        "secret": (F.when(form == 0, key).when(form == 1, mixed).when(form == 2, hexes).otherwise(phrase), F.when(form == 0, uuid).when(form == 1, name).when(form == 2, code).otherwise(hexes)),
    }
    words = {
        "email": (" mail ", " contact ", " write to ", " reach me: "), "ip": (" server ip ", " host ", " address: ", " ping "), "card": (" card ", " credit card: ", " visa ", " payment "),
        "phone": (" phone: ", " call ", " tel. ", " fax "), "secret": (" password=", ' token = "', " api_key: ", " secret="),
    }
    hit = F.coalesce(*[F.when(kind == k, F.when(meant, yes).otherwise(no)) for k, (yes, no) in hits.items()])
    cue = F.coalesce(*[F.when(kind == k, pick(34, *some)) for k, some in words.items()])
    plain = pick(33, " the quick brown ", " und die ", " of that, ", " in. ")
    other = pick(35, " order ", " invoice no. ", " part ", " date: ", " isbn ", " ref #", " commit ", " price ")
    # A password in plain words is one only where it is assigned, and so is one in hexadecimal digits, which commits and checksums are too.
    before = F.when((kind == "secret") & meant & (form >= 2), cue).when((kind == "secret") & ~meant & (form == 3) & (beside < 4), plain).when(beside < 4, cue).when(beside < 7, plain).otherwise(other)
    in_place = beside < 7
    label = F.when(kind.isin("email", "ip"), meant).when(kind == "card", _luhn(_digits(hit)) & in_place).when(kind == "phone", meant & in_place).otherwise(meant)
    rows = spark.range(0, n, 1, 1).select("id", kind.alias("kind"), hit.alias("hit"), before.alias("before"), pick(37, " ", ". ", ", ", "\n").alias("after"), label.cast("int").cast("double").alias("label"), F.pmod(F.xxhash64("id", F.lit(38)), F.lit(3)).alias("part"))
    return rows.where("hit is not null")


def _compiled(dump: str, inputs: list[str]) -> str:
    """A regression tree's printed form as a SQL expression over the inputs."""
    lines = [x.strip() for x in dump.splitlines()]
    at = next(i for i, x in enumerate(lines) if x.startswith(("If", "Predict")))

    def node() -> str:
        nonlocal at
        line, at = lines[at], at + 1
        if line.startswith("Predict"):
            return f"{float(line.split(':')[1])!r}D"
        feature, limit = re.match(r"If \(feature (\d+) <= ([-0-9.eE]+)\)", line).groups()
        yes = node()
        at += 1  # its Else
        return f"(case when {inputs[int(feature)]} <= {float(limit)!r}D then {yes} else {node()} end)"

    return node()


@lru_cache(4)
def _model(seed: int) -> tuple[str, dict[str, float]]:
    """The boosted trees as SQL over x[0], x[1], ..., and the margin from which each kind counts. The same in each session."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    spark = SparkSession.active()
    rows = training_rows(spark).withColumn("x", F.array(*_features(F.col("kind"), F.col("hit"), F.col("before"), F.col("after"))))
    n = len(_features(F.lit(""), F.lit(""), F.lit(""), F.lit("")))
    flat = rows.select("kind", "label", "part", "x", *[F.col("x")[i].alias(f"x{i}") for i in range(n)])
    flat = VectorAssembler(inputCols=[f"x{i}" for i in range(n)], outputCol="features").transform(flat).persist()
    trained = GBTClassifier(maxIter=ROUNDS, maxDepth=LEVELS, stepSize=0.3, seed=seed).fit(flat.where("part > 0").coalesce(1))
    names = [f"x[{i}]" for i in range(n)]
    margin = " + ".join(f"{w!r}D * {_compiled(t.toDebugString, names)}" for w, t in zip(trained.treeWeights, trained.trees, strict=True))
    held = flat.where("part = 0").select("kind", "label", F.expr(margin).alias("m")).groupBy("kind", "m").agg(F.sum("label").alias("right"), F.count("*").alias("n"))
    held.createOrReplaceTempView("voltweave_pii_held")
    down = spark.sql("select kind, m, sum(right) over w / sum(n) over w as precision from voltweave_pii_held window w as (partition by kind order by m desc)")
    limits = down.where(F.col("precision") >= PRECISION).groupBy("kind").agg(F.min("m").alias("m")).collect()
    spark.catalog.dropTempView("voltweave_pii_held")
    flat.unpersist()
    return margin, {r["kind"]: r["m"] for r in limits}


def _by_rule(kind: str, found: Column) -> Column:
    held = F.filter(found, lambda s: _holds(kind, s["hit"]))
    return F.transform(held, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(True).alias("base")))


def _proposals(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.array(*_features(F.lit(kind), s["hit"], s["before"], s["after"])).alias("x")))


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _without(df: DataFrame, name: str, others: str, worse: str) -> DataFrame:
    """Column name (spans p by start) without those that a span q of others (by start) overlaps for which worse holds.

    Both are read in blocks of BLOCK spans, and a block meets only the others' blocks that reach into it.
    """
    for side, c in (("p", name), ("q", others)):
        blocks = f"transform(case when size({c}) > 0 then sequence(0L, (size({c}) - 1) div {BLOCK}) else cast(array() as array<bigint>) end, i -> slice({c}, cast(i * {BLOCK} + 1 as int), {BLOCK}))"
        df = df.withColumn(f"_pii_{side}", F.expr(f"transform({blocks}, b -> named_struct('spans', b, 'low', b[0].start, 'high', array_max(transform(b, x -> x.end))))"))
    near = "flatten(transform(filter(_pii_q, q -> q.low < p.high and p.low < q.high), q -> q.spans))"
    df = df.withColumn("_pii_p", F.expr(f"transform(_pii_p, p -> named_struct('spans', p.spans, 'near', {near}))"))
    kept = f"filter(b.spans, p -> not exists(b.near, q -> q.start < p.end and p.start < q.end and {worse}))"
    return df.withColumn(name, F.expr(f"flatten(transform(_pii_p, b -> {kept}))"))


def find(docs: DataFrame, seed: int = 5) -> DataFrame:
    """docs (columns as given) with `_pii`: array<struct<kind, start, end, base>> by kind, then start; base: by the rules.

    Null text has no spans. Proposed spans are taken where their score reaches their kind's threshold and no rule's span of any kind and
    no better proposal (by score, then length, then start) overlaps them; a secret may hold a shorter rule's span.
    """
    margin, limits = _model(seed)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn("_pii_text", text)
    digits = F.col("_pii_text").rlike("[0-9]")
    cheap = {"email": F.contains(F.col("_pii_text"), F.lit("@")), "ip": digits, "card": digits, "phone": F.contains(F.col("_pii_text"), F.lit("+"))}
    span = "struct<kind:string,start:int,end:int,base:boolean>"
    rules = {f"_pii_{kind}": (pattern, cheap[kind]) for kind, pattern in _RULES.items()}
    generators = {f"_pii_{kind}{i}": (pattern, F.lit(True) if kind == "email" else digits) for kind, some in _GENERATORS.items() for i, pattern in enumerate(some)}
    df = _with_found(df, rules | generators)
    df = df.withColumn("_pii_base", F.concat(*[_by_rule(k, F.col(f"_pii_{k}")) for k in KINDS]))
    proposed = [_proposals(kind, F.col(f"_pii_{kind}{i}")) for kind, some in _GENERATORS.items() for i in range(len(some))]
    df = df.withColumn("_pii_proposed", F.concat(*proposed))
    limit = " ".join(f"when '{k}' then {v!r}D" for k, v in sorted(limits.items())) or "when '' then 0D"
    scored = F.expr(f"transform(_pii_proposed, p -> named_struct('start', p.start, 'end', p.end, 'kind', p.kind, 'm', {margin.replace('x[', 'p.x[')}))")
    df = df.withColumn("_pii_scored", F.when(F.size("_pii_proposed") > 0, scored).otherwise(F.array().cast("array<struct<start:int,end:int,kind:string,m:double>>")))
    df = df.withColumn("_pii_scored", F.expr(f"array_sort(filter(_pii_scored, p -> p.m >= case p.kind {limit} end))"))
    df = df.withColumn("_pii_ruled", F.expr("array_sort(transform(_pii_base, b -> named_struct('start', b.start, 'end', b.end)))"))
    # A secret may reach beyond a rule's span that lies in it; nothing else overlaps one.
    df = _without(df, "_pii_scored", "_pii_ruled", "not (p.kind = 'secret' and p.start <= q.start and q.end <= p.end and q.end - q.start < p.end - p.start)")
    df = _without(df, "_pii_scored", "_pii_scored", "(q.m > p.m or (q.m = p.m and (q.end - q.start > p.end - p.start or (q.end - q.start = p.end - p.start and (q.start < p.start or (q.start = p.start and q.kind < p.kind))))))")
    df = df.withColumn("_pii_more", F.expr("array_distinct(transform(_pii_scored, p -> named_struct('kind', p.kind, 'start', p.start, 'end', p.end, 'base', false)))"))
    every = F.concat("_pii_base", F.col("_pii_more").cast(f"array<{span}>"))
    rank = "(case {0}.kind when 'email' then 0 when 'ip' then 1 when 'card' then 2 when 'phone' then 3 else 4 end)"
    df = df.withColumn("_pii", every)
    key = lambda s: f"{rank.format(s)} * 4294967296 + {s}.start"
    df = df.withColumn("_pii", F.expr(f"array_sort(_pii, (a, b) -> cast(sign(({key('a')}) - ({key('b')})) as int))"))
    return df.select(*[df[c] for c in docs.columns], "_pii")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more of every row of docs (doc_id, text).

    The counts and the digest are of the rules' spans; spans lists those and the proposals taken. Null or empty text has none. Repeated
    rows are reported as often as they occur; other columns aren't read. An empty table gives an empty report.
    """
    df = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    df = df.withColumn("_pii_base", F.filter("_pii", lambda s: s["base"]))
    counts = [F.size(_of_kind("_pii_base", k)).cast("long").alias(f"n_{k}") for k in KINDS]
    more = (F.size("_pii") - F.size("_pii_base")).cast("long")
    return df.select("doc_id", *counts, F.sha2(_listed(F.col("_pii_base")), 256).alias("base_sha256"), _listed(F.col("_pii")).alias("spans"), more.alias("n_more"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span found in its text replaced by its kind in angle brackets; overlapping spans count as one, named after the first.

    Columns and rows as given: null and empty texts stay, repeated rows are redacted each, spans that start together are named after the
    longest, and an empty table stays empty.
    """
    df = find(docs)
    text = F.col("text").cast("string")
    by_start = F.expr("array_sort(_pii, (a, b) -> case when a.start <> b.start then a.start - b.start else b.end - a.end end)")
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["pos"]
        parts = F.concat(a["parts"], F.array(F.substr(text, a["pos"] + 1, s["start"] - a["pos"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
        return F.struct(F.greatest(a["pos"], s["end"]).alias("pos"), F.when(fresh, parts).otherwise(a["parts"]).alias("parts"))

    whole = F.aggregate(by_start, zero, step, lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["pos"] + 1)))
    clean = F.when(F.size("_pii") > 0, whole).otherwise(text)
    return df.select(*[clean.alias(c) if c == "text" else df[c] for c in docs.columns])
