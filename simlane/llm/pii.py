"""Personal data: fixed patterns, and candidates beside them that weak labelers vote on.

Regex, check, gazetteer, context, boundary and variety labelers vote for or against each candidate; expectation
maximisation over the counts of vote patterns estimates how often each labeler says what of personal data and of other
things. Matches of the fixed patterns are known: those whose checks hold are personal data, those whose checks fail
aren't; the labelers' rates on them carry over to the candidates that no fixed pattern covers. A logistic span classifier is
trained on the resulting beliefs and decides on those candidates. All work on texts is DataFrame functions, in time
that grows with the text's length; what comes to the driver is the table of signal counts, at most 4 x 3 x 3 x 2^6 rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simlane.llm.common import pick, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KINDS = ("email", "ip", "card", "phone")
#: Marks the ends of matches; a text's own marks are replaced before by another character that no pattern has.
MARK, OTHER = "", ""
#: The patterns, with possessive groups (Java matches those without recursion, so a long text can't exhaust the stack)
#: and starts only at the begin of a run or where the last match ended, so that a long run is not tried at each place.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates that only the labelers can confirm: spelled-out addresses and those with letters beyond ASCII, addresses of
#: hosts with bracketed dots or in eight hexadecimal groups, cards with other separators, numbers without a plus sign or with more digits behind them.
WEAK = {
    "email": r"(?i)(?:(?<![\p{L}0-9._%+-])|\G)[\p{L}0-9._%+-]++(?:@| ?[(\[](?:at|@)[)\]] ?)[\p{L}0-9-]++(?: ?(?:\.|[(\[](?:dot|\.)[)\]]) ?[\p{L}0-9-]++)++",
    "ip": r"(?i)(?<![0-9])[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}(?![0-9])|(?<![0-9a-z:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-z:])",
    "card": r"(?<![0-9])[0-9]{4}(?:(?:[./_]|[\x20-]{2,3})[0-9]{4,7}){2,3}(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?[(]?[0-9]{2,4}[)]?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])|(?<![0-9+.-])[(]?[0-9][\x20().0-9-]{7,20}[0-9](?![0-9])",
}
#: Forms that speak for a kind: the regex labeler.
STRICT = {
    "email": r"(?i)@|[(\[](?:at|@)[)\]].*(?:[(\[](?:dot|\.)[)\]]|\.)",
    "ip": r"[.:]",
    "card": r"^[0-9]{4}(?:[^0-9]{0,3}[0-9]{4}){3}$|^3[47][0-9]{2}[^0-9]{0,3}[0-9]{6}[^0-9]{0,3}[0-9]{5}$",
    "phone": r"^\+|^[(]?0?[0-9]{2,4}[)]?[\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{4}$|^[(]0?[0-9]{2,4}[)][\x20.-]?[0-9]{3,8}$|^0[0-9]{2,4}[\x20-][0-9]{5,8}$|^00[1-9]",
}
# Top-level domains, words before a span that speak for or against it, calling codes, card issuers.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|de|fr|es|uk|us|eu|at|ch|it|nl|be|pl|ca|au|jp|cn|in|br|mx|ru|se|no|dk|fi"
CUES = {
    "email": "mail|contact|write|schreib|correo|courriel|kontakt|contacto|reach",
    "ip": r"\bip\b|host|server|address|adresse|direcci|client|login|from",
    "card": "card|karte|tarjeta|carte|visa|credit|kredit|payment|pay|zahlung|pago",
    "phone": "phone|tel|call|mobile|fax|handy|anruf|llam|appel|ruf|whatsapp",
}
AGAINST = r"version|order|invoice|token|sha|hash|isbn|date|bestell|rechnung|pedido|factura|commande|release|\bid\b|no\.|#"
ISSUERS = "(?:4|5[1-5]|2[2-7]|3[4-7]|6011|64[4-9]|65|62|50|5[6-9]|6)"

#: Entries of an array that a fold adds to at once, as adding to an array copies it; characters of a page of a text that is cut.
BLOCK, PAGE = 128, 256
FOUND = "struct<start:int,kind:int,end:int,base:boolean,signals:string>"


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _parts(t: Column, pattern: str) -> Column:
    """The text cut at the ends of matches: matches have odd places."""
    return F.split(F.regexp_replace(t, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK, -1)


def _blocks(values: Column, kind: str) -> Column:
    last = ((F.size(values) - 1) / BLOCK).cast("int")
    return F.when(F.size(values) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))).otherwise(_empty(f"array<{kind}>"))


def _fold(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each value what join has made of zero and all values before it."""
    start = F.struct(zero.cast("int").alias("pos"), _empty("int").alias("out"))
    return F.aggregate(values, start, lambda s, x: F.struct(join(s["pos"], x).cast("int").alias("pos"), F.concat(s["out"], F.array(s["pos"])).alias("out")), lambda s: s["out"])


def _heads(blocks: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What join has made of all blocks before each."""
    return _fold(F.transform(blocks, lambda b: F.aggregate(b, zero.cast("int"), lambda s, x: join(s, x).cast("int"))), zero, join)


def _before(blocks: Column, heads: Column, join: Callable[[Column, Column], Column]) -> Column:
    """_fold() over the values of all blocks, in two levels, so that it takes a time that grows as their number does.
    Arrays that go with each other are zipped: one that a function refers to by index may be computed anew each time."""
    return F.flatten(F.zip_with(blocks, heads, lambda b, h: _fold(b, h, join)))


def running(d: DataFrame, names: list[str], zero: Column, join: Callable[[Column, Column], Column], **of: Column) -> DataFrame:
    """The named columns and one for each of the array<int> columns given: for each place what join makes of zero and
    all values before it."""
    d = d.select(*names, *[c.alias(n) for n, c in of.items()])
    cut = d.select(*names, *[_blocks(F.col(n), "int").alias(f"_{n}") for n in of])
    cut = cut.select(*names, *[f"_{n}" for n in of], *[_heads(F.col(f"_{n}"), zero, join).alias(f"_{n}_heads") for n in of])
    return cut.select(*names, *[_before(F.col(f"_{n}"), F.col(f"_{n}_heads"), join).alias(n) for n in of])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of ASCII digits holds."""

    def add(s: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, -i, 1)) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return s + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def _apart(m: Column) -> Column:
    return F.filter(F.split(m, "[^0-9]+"), lambda p: p != "")


def _small(part: Column) -> Column:
    """A decimal number of any length is at most 255."""
    p = F.regexp_replace(part, "^0+", "")
    return (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))


def _by_kind(kind: Column, **of: Column) -> Column:
    """The column named for a kind, or null."""
    out = F.lit(None)
    for name, c in of.items():
        out = F.when(kind == KINDS.index(name), c).otherwise(out)
    return out


def holds(kind: Column, m: Column) -> Column:
    """The check of a kind's match; kind is its place in KINDS."""
    n = F.length(_digits(m))
    card = F.when(n.between(12, 19), luhn(_digits(m))).otherwise(False)
    ip = F.contains(m, F.lit(":")) | F.forall(_apart(m), _small)
    return _by_kind(kind, email=F.lit(True), ip=ip, card=card, phone=n.between(9, 15))


def _signals(c: Column) -> Column:
    """One character each: kind, how it is known (1: fixed pattern and check, x: fixed pattern without, 0: neither), check,
    gazetteer, context, both boundaries, variety of digits, form."""
    kind, m, before, after = c["kind"], c["m"], F.lower(c["before"]), c["after"]
    known = _by_kind(
        kind, email=F.lower(m).rlike(rf"[.)\] ](?:{DOMAINS})$"), ip=~m.rlike(r"^(?:0|10|127|169\.254|192\.168|22[4-9]|2[3-5][0-9])[.\[(]"),
        card=_digits(m).rlike(f"^{ISSUERS}"), phone=m.rlike(r"^(?:\+|00)[1-9]|^[(]?0[1-9]|^[(]?[2-9][0-9]{2}[)]?[\x20.-]"),
    )
    cue = _by_kind(kind, **{k: F.lit(x) for k, x in CUES.items()})
    form = _by_kind(kind, **{k: m.rlike(x) for k, x in STRICT.items()})
    varied = (kind == 0) | (F.size(F.array_distinct(F.split(_digits(m), ""))) > 3)
    one = lambda c: F.when(c, "1").otherwise("0")
    context = F.when(before.rlike(AGAINST), "-").when(F.rlike(before, cue), "+").otherwise("0")
    letter = _by_kind(kind, **{k: F.lit(k[0]) for k in KINDS})
    state = F.when(c["base"], "1").when(c["weak"], "0").otherwise("x")
    return F.concat(letter, state, one(c["check"]), one(known), context, one(~before.rlike("[A-Za-z0-9]$")), one(~after.rlike("^[A-Za-z0-9]")), one(varied), one(form))


def found(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns, t (the text, marks replaced) and found: all candidates as (start, kind, end, base, signals), in
    order of start, then kind as in KINDS. base marks matches of the fixed patterns whose checks hold; other candidates
    that overlap one of these are left out. A candidate's context is the text since the match of its pattern before it,
    and that match, at most 24 characters."""
    t = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(MARK), F.lit(OTHER))
    d = pick(docs, *dict.fromkeys([*columns, "text"])).withColumn("t", t)
    t, digit = F.col("t"), F.col("digit")
    names = [*columns, "t"]
    d = d.select(*names, t.rlike("[0-9]").alias("digit"))
    # the fixed patterns in the order of KINDS, then the weak ones; each is searched only where the text has what it needs
    at = F.contains(t, F.lit("@"))
    searched = [
        (0, PATTERNS["email"], at), (1, PATTERNS["ip"], digit), (2, PATTERNS["card"], digit), (3, PATTERNS["phone"], digit & F.contains(t, F.lit("+"))),
        (0, WEAK["email"], at | t.rlike(r"(?i)[(\[]at[)\]]")), (1, WEAK["ip"], digit & t.rlike(r"[\[(]\.[\])]|:[0-9A-Fa-f]{1,4}:")), (2, WEAK["card"], digit), (3, WEAK["phone"], digit),
    ]
    parts = [f"p{i}" for i in range(len(searched))]
    d = d.select(*names, *[F.when(on, _parts(t, p)).otherwise(F.array(t)).alias(n) for n, (_, p, on) in zip(parts, searched, strict=True)])
    size = {f"s{n}": F.when(F.size(n) > 1, F.transform(n, F.length)).otherwise(_empty("int")) for n in parts}
    d = running(d, [*names, *parts], F.lit(0), lambda s, x: s + x, **size)

    def candidates(i: int) -> Column:
        kind, weak, part, start = F.lit(searched[i][0]), i >= len(KINDS), F.col(parts[i]), F.col(f"s{parts[i]}")
        none = F.lit("")

        def of(k: Column) -> Column:
            m = F.get(part, k)
            before = F.right(F.concat(F.coalesce(F.get(part, F.when(k > 1, k - 2)), none), F.get(part, k - 1)), F.lit(24))
            after = F.left(F.concat(F.get(part, k + 1), F.coalesce(F.get(part, k + 2), none)), F.lit(1))
            check = holds(kind, m)
            return F.struct(F.get(start, k).alias("start"), (F.get(start, k) + F.length(m)).alias("end"), m.alias("m"), before.alias("before"), after.alias("after"), kind.alias("kind"), check.alias("check"), F.lit(weak).alias("weak"), (check & F.lit(not weak)).alias("base"))

        n = lambda s: F.length(_digits(s["m"]))
        wanted = {0: lambda s: F.lit(True), 1: lambda s: F.lit(True), 2: lambda s: n(s).between(12, 19), 3: lambda s: n(s).between(9, 15) if weak else n(s) >= 7}[searched[i][0]]
        every = F.transform(F.sequence(F.lit(1), F.size(part) - 1, F.lit(2)), of)
        return F.when(F.size(part) > 1, F.filter(every, wanted))

    kind = "array<struct<start:int,end:int,m:string,before:string,after:string,kind:int,check:boolean,weak:boolean,base:boolean>>"
    d = d.select(*names, F.flatten(F.array(*[F.coalesce(candidates(i).cast(kind), _empty(kind[6:-1])) for i in range(len(searched))])).alias("met"))
    every = F.transform("met", lambda c: F.struct(c["start"], c["kind"], c["end"], c["base"], _signals(c).alias("signals")).cast(FOUND))
    d = d.select(*names, F.array_sort(every).alias("found"))
    # how far the fixed matches before a candidate reach, and where the first one after it begins
    reach = F.transform("found", lambda x: F.when(x["base"], x["end"]).otherwise(0))
    begins = F.reverse(F.transform("found", lambda x: F.when(x["base"], -x["start"] - 1).otherwise(-(2**31) + 1)))
    d = running(d, [*names, "found"], F.lit(-(2**31) + 1), F.greatest, reach=reach, begins=begins)
    d = d.select(*names, F.arrays_zip("found", "reach", F.reverse("begins").alias("begins")).alias("zipped"))
    clear = F.filter("zipped", lambda z: z["found"]["base"] | ((z["reach"] <= z["found"]["start"]) & (-z["begins"] - 1 >= z["found"]["end"])))
    return d.select(*names, F.transform(clear, lambda z: z["found"]).alias("found"))


def votes(signals: str) -> list[int]:
    """What each labeler says of a candidate: 1 for, -1 against, 0 nothing. Regex, check, gazetteer, context, boundary, variety."""
    kind, _, check, known, context, left, right, varied, form = signals
    checked = -1 if check == "0" else 1 if kind in "ci" else 0
    gazetteer = 1 if known == "1" else -1 if kind in "cp" else 0
    return [1 if form == "1" else -1, checked, gazetteer, {"+": 1, "-": -1, "0": 0}[context], -1 if left + right != "11" else 0, -1 if varied == "0" else 0]


#: Votes that stand for what is known of any labeler before it is met: of ten on personal data, and (reversed) on others.
PRIOR = {1: 6.0, 0: 3.0, -1: 1.0}
#: Labelers whose votes the fixed patterns imply, so that known candidates say nothing about them.
IMPLIED = (0, 1)


def reliabilities(counts: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], dict[str, float], list[float]]:
    """Belief in each pattern of signals, share of personal data among each kind's unknown candidates, and reliability of
    each labeler (the share of its votes that are right), by expectation maximisation. A labeler says 1, 0 or -1 with
    rates of its own for personal data and for others, whatever the other labelers say. Known candidates keep belief 1
    or 0; no rate or share is held within bounds, PRIOR alone keeps them from 0 and 1."""
    said = {s: votes(s) for s in counts}
    fixed = {"1": 1.0, "x": 0.0}
    many = len(next(iter(said.values()), []))
    rate = [{y: {v: PRIOR[v if y else -v] / 10 for v in PRIOR} for y in (0, 1)} for _ in range(many)]
    share = {k[0]: 0.5 for k in KINDS}
    belief: dict[str, float] = {}
    for _ in range(rounds):
        for s, v in said.items():
            odds = log(share[s[0]] / (1 - share[s[0]])) + sum(log(rate[j][1][x] / rate[j][0][x]) for j, x in enumerate(v))
            belief[s] = fixed.get(s[1], 1 / (1 + exp(-max(-50.0, min(50.0, odds)))))
        for k in share:
            own = [(c, belief[s]) for s, c in counts.items() if s[0] == k and s[1] == "0"]
            share[k] = (1 + sum(c * b for c, b in own)) / (2 + sum(c for c, _ in own))
        for j in range(many):
            own = [(s, c) for s, c in counts.items() if s[1] == "0" or j not in IMPLIED]
            for y in (0, 1):
                total = 10 + sum(c * abs(1 - y - belief[s]) for s, c in own)
                for x in PRIOR:
                    rate[j][y][x] = (PRIOR[x if y else -x] + sum(c * abs(1 - y - belief[s]) for s, c in own if said[s][j] == x)) / total
    trust = []
    for j in range(many):
        right = sum(c * (belief[s] if said[s][j] > 0 else 1 - belief[s]) for s, c in counts.items() if said[s][j])
        trust.append((1 + right) / (2 + sum(c for s, c in counts.items() if said[s][j])))
    return belief, share, trust


@dataclass
class Model:
    """Weights of the span classifier by place and character of the signals, and its bias."""

    weights: dict[str, float]
    bias: float
    trust: list[float]

    def score(self, signals: str) -> float:
        z = self.bias + sum(self.weights.get(f"{i}{c}", 0.0) for i, c in enumerate(signals))
        return 1 / (1 + exp(-max(-50.0, min(50.0, z))))

    def accepts(self, signals: Column) -> Column:
        """The same score in SQL, at least one half."""
        if not self.weights:
            return F.lit(False)
        table = F.create_map(*[F.lit(x) for k, w in sorted(self.weights.items()) for x in (k, float(w))])
        z = F.lit(float(self.bias))
        for i in range(9):
            z = z + F.coalesce(F.try_element_at(table, F.concat(F.lit(str(i)), F.substring(signals, i + 1, 1))), F.lit(0.0))
        return z >= 0


def fit_counts(counts: dict[str, int], rounds: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> Model:
    """The classifier on signals, trained on the beliefs; a candidate weighs as often as it occurs, up to the logarithm
    of the count, so that frequent patterns don't drown the others. How a candidate is known is no feature."""
    if not counts:
        return Model({}, 0.0, [])
    belief, _, trust = reliabilities(counts)
    rows = [([f"{i}{c}" for i, c in enumerate(s) if i != 1], belief[s], 1 + log(n)) for s, n in sorted(counts.items())]
    total = sum(r[2] for r in rows)
    w = {f: 0.0 for r in rows for f in r[0]}
    bias = 0.0
    for _ in range(rounds):
        g, gb = {f: ridge * x for f, x in w.items()}, 0.0
        for fs, y, n in rows:
            z = bias + sum(w[f] for f in fs)
            e = n / total * (1 / (1 + exp(-max(-50.0, min(50.0, z)))) - y)
            gb += e
            for f in fs:
                g[f] += e
        bias -= rate * gb
        for f in w:
            w[f] -= rate * g[f]
    return Model(w, bias, trust)


def fit(docs: DataFrame) -> Model:
    """The labelers' reliabilities and the classifier, from the candidates of all documents. The signals are written
    before they are counted: over an explode the optimizer would repeat the search for each filter it infers."""
    signals = staged(found(docs).select(F.transform("found", lambda x: x["signals"]).alias("s")))
    rows = signals.select(F.explode("s").alias("s")).groupBy("s").count().collect()
    return fit_counts({r["s"]: r["count"] for r in rows})


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def detect(docs: DataFrame, model: Model | None = None, *columns: str) -> DataFrame:
    """The columns (doc_id at least), t and spans: the fixed patterns' matches and the candidates the model accepts."""
    model = model or fit(docs)
    d = found(docs, *(columns or ("doc_id",)))
    return d.withColumn("spans", F.filter("found", lambda x: x["base"] | model.accepts(x["signals"])))


def spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of the fixed patterns), base_sha256 and spans of each row.

    A null text is empty and has none; counts are 0 and strings empty then. Texts are searched whole. Rows with equal or
    null ids are each reported; other columns are ignored; an empty table gives no rows."""
    d = detect(docs, model).withColumn("base", F.filter("spans", lambda x: x["base"]))
    def of(kind: int) -> Callable[[Column], Column]:
        return lambda x: x["kind"] == kind

    n = [F.size(F.filter("base", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return d.select("doc_id", *n, F.sha2(_named(F.col("base")), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of docs with each span replaced by its kind in brackets, spans that overlap by that of the first; n_chars
    is that of the new text where a span was replaced. Rows without a span are as they were."""
    d = detect(docs, model, *COLUMNS).drop("t", "found")
    names = [*COLUMNS, "spans"]
    d = running(d, names, F.lit(0), F.greatest, reach=F.transform("spans", lambda x: x["end"]))
    # a span that begins where all before it have ended begins a group
    joined = F.filter(F.zip_with("spans", "reach", lambda x, r: F.struct(x["start"], x["kind"], r.alias("reach"))), lambda x: x["start"] >= x["reach"])
    far = F.array_max(F.transform("spans", lambda x: x["end"]))
    d = d.select(*COLUMNS, far.alias("far"), joined.alias("groups"), F.when(F.size("spans") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))).alias("pages"))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(first: Column, last: Column) -> Column:
        """A piece of the text, from the pages it lies in, so that it is found without counting from the text's begin."""
        page = F.floor(first / PAGE).cast("int")
        some = F.slice(F.col("pages"), page + 1, F.floor((last - 1) / PAGE).cast("int") - page + 1)
        return F.substring(F.array_join(some, ""), first - page * PAGE + 1, last - first)

    # what a group's spans before it reach is where the group before it ends
    pieces = F.transform("groups", lambda x: F.concat(cut(x["reach"], x["start"]), F.get(kinds, x["kind"])))
    size = F.length("text")
    rest = F.when(size > F.col("far"), cut(F.col("far"), size)).otherwise("")
    hit = F.col("pages").isNotNull()
    d = d.select("doc_id", F.when(hit, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("text")).alias("text"), "lang", "source", "n_chars", hit.alias("hit"))
    return d.select("doc_id", "text", "lang", "source", F.when(F.col("hit"), F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))
