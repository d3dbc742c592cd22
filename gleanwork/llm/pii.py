"""Personal data: strict patterns, and wider candidates that boosted trees accept or refuse.

Strict kinds: e-mail, IP address, card number (Luhn), phone number. Generators of high recall also
propose spans: any number of 7 or more digits with separators, and addresses spelt with "at" and
"dot". Evidence labels a candidate: it is positive if it overlaps a strict span, is announced by a word like
"phone" or "mail", is laid out like a phone number or ends in a known domain; negative if it is part of a word, announced as
something else, a date, an amount, a bare number or a long one without checksum. Without evidence it has no label.

Labels serve training only. Every candidate is described by whole-numbered features of its format and context, with
the kind of evidence as one of them, and boosted trees alone accept or refuse it. The labelled candidates of all documents are added
up per combination of features (at most `CELLS` by construction), half of them by hash of the text to fit and half to calibrate.
To both halves come `PRIOR_ROWS` rows for each clear case of `PRIOR`, so that small corpora can be judged too; these are never hidden.
Trees of depth two are boosted on those sums for log loss and become one SQL expression. They are fitted on every combination as it
is and with its giveaways (`HIDDEN`) set to zero, so that they must also tell by format. There are two thresholds, each the lowest at which `PRECISION`
of the calibration half's candidates are positive: one for candidates with evidence, calibrated on those as they are, one for the rest,
calibrated on all with their giveaways hidden. Added are the candidates outside strict spans that reach theirs, but for
those that lie within another one. Redaction joins spans that overlap otherwise, so that no part of an accepted one stays.

Null texts are empty; ids are not read. Empty table: empty result. Without a threshold that is precise enough
candidates of that sort are all refused. Everything is local to its row, apart from the sums per combination.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.names import quoted
from gleanwork.llm.spans import all_of, bound, count_upto, digits, edges, luhn, meets, tagged, with_matches
from gleanwork.session import released

# A match may start after another one or where its first run of characters starts; elsewhere it would fail alike.
STRICT = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
WIDE = {
    "number": "\\+?\\(?[0-9](?:[\\x20().-]{0,2}[0-9]){6,}+",
    "spelt": "(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\\x20?(?:\\(at\\)|\\[at\\]|\\x20at\\x20)\\x20?[A-Za-z0-9-]++(?:\\x20?(?:\\(dot\\)|\\[dot\\]|\\x20dot\\x20)\\x20?[A-Za-z0-9-]++)++",
}
#: What every match of a costly pattern holds.
NEEDS = {"email": "@[A-Za-z0-9-]++\\.", "ip": "\\.[0-9]++\\.[0-9]", "spelt": "(?i)\\(dot\\)|\\[dot\\]|\\x20dot\\x20"}
KINDS = [*STRICT, *WIDE]
PRECISION = 0.95
ROUNDS = 30
RATE = 0.3
#: Features that give a label away.
HIDDEN = ("plus", "called", "evidence")
_SO = "(?:[^a-z0-9]+(?:me|us|at|on|is|no|nr|number|address|under|to))*[^a-z0-9]*$"
CALLED = {
    "number": "(?:^|[^\\p{L}])(?:tel|telephone|phone|call|mobile|mobil|cell|fax|sms|whatsapp|telefon|tel\u00e9fono|t\u00e9l\u00e9phone)" + _SO,
    "spelt": "(?:^|[^\\p{L}])(?:e-?mail|mail|contact|write|reach|correo|kontakt|courriel)" + _SO,
}
OTHERWISE = "(?:^|[^\\p{L}])(?:order|invoice|isbn|issn|id|no|nr|ref|reference|version|serial|sku|page|pages|pp|doi|section|ticket|build)(?:[^a-z0-9]+(?:id|is|no|nr|number))*[^a-z0-9]*$|[$\u20ac\u00a3#/=_-]$"
#: Bracketed area code; three, three and four figures; international prefix.
LAYOUT = "^\\+?(?:[0-9]{1,3}[\\x20.-]?)?\\([0-9]{2,5}\\)[\\x20.-]?[0-9]{2,4}(?:[\\x20.-]?[0-9]{2,4})+$|^(?:1[\\x20.-])?[0-9]{3}([\\x20.-])[0-9]{3}\\1[0-9]{4}$|^00[1-9][0-9]{0,2}[\\x20.-]"
#: Dates, ranges of years, amounts, four dotted numbers.
NOT_A_PHONE = "^(?:19|20)[0-9]{2}[\\x20.-][0-9]{1,2}[\\x20.-][0-9]{1,2}(?![0-9])|^[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)[0-9]{2}(?![0-9])|^(?:19|20)[0-9]{2}[\\x20-]{1,2}(?:19|20)[0-9]{2}$|^[0-9]{1,3}(?:[\\x20.][0-9]{3}){2,}$|^[0-9]+\\.[0-9]+$|^[0-9]+(?:\\.[0-9]+){3}$"
DOMAIN = "(?i)(?:\\(dot\\)|\\[dot\\]|\\x20dot\\x20)\\x20?(?:com|org|net|edu|gov|info|biz|eu|io|ai|app|dev|co|me|[a-z]{2})$"
RESULT = ("base", "spans")
#: Characters of text cut at once in redaction.
PIECE = 4096
SPAN = ("start", "place", "end", "kind")


def _features(m: Column, wide: str) -> dict[str, Column]:
    """Small whole numbers, each below the bound in `BOUNDS`."""
    hit, n = m["hit"], m["n"]
    words = F.lower(m["before"])
    return {
        "spelt": F.lit(int(wide == "spelt")),
        "length": F.when(n < 9, 0).when(n < 12, 1).when(n < 16, 2).when(n == 16, 3).when(n < 20, 4).otherwise(5),
        "separators": F.least(F.length(F.ltrim(hit, F.lit("+"))) - n, F.lit(5)),
        "plus": hit.startswith("+").cast("int"),
        "dots": F.least(F.length(F.regexp_replace(hit, "[^.]", "")), F.lit(4)),
        "checksum": m["checked"].cast("int"),
        "called": F.when(words.rlike("tel|phone|call|mobile|fax"), 1).when(words.rlike("card|visa|iban|account"), 2).otherwise(0),
        "glued": (words.rlike("[\\p{L}0-9_]$") | m["after"].rlike("[\\p{L}0-9_]")).cast("int"),
        "evidence": _evidence(m, wide),
    }


def _evidence(m: Column, wide: str) -> Column:
    """3: announced, 2: laid out as one, 1: announced or laid out as something else, 0: none."""
    hit, words = m["hit"], F.lower(m["before"])
    announced = F.when(words.rlike(CALLED[wide]), 3)
    if wide == "spelt":
        return announced.when(hit.rlike(DOMAIN) | hit.rlike("(?i)[\\[(]at[\\])]"), 2).otherwise(0)
    return announced.when(words.rlike(OTHERWISE) | hit.rlike(NOT_A_PHONE), 1).when(hit.rlike(LAYOUT), 2).otherwise(0)


def _label(w: Column) -> Column:
    """1 or 0 by evidence, null without any, of a described candidate."""
    spelt, plain, checked = w["spelt"] == 1, w["separators"] == 0, w["checksum"] == 1
    short = w["length"] < 3
    return (F.when(w["strict"], 1)
            .when(spelt, (w["evidence"] > 1).cast("int"))
            .when(w["glued"] == 1, 0)
            .when((w["evidence"] == 3) & short, 1)
            .when((w["evidence"] == 1) | (plain & ~checked), 0)
            .when((w["evidence"] == 2) & short, 1)
            .when((w["n"] > 12) & ~checked, 0))


BOUNDS = {"spelt": 2, "length": 6, "separators": 6, "plus": 2, "dots": 5, "checksum": 2, "called": 3, "glued": 2, "evidence": 4}
FEATURES = list(BOUNDS)
CELLS = math.prod(BOUNDS.values())
_NUMBER, _SPELT = {"length": 1, "separators": 2}, {"spelt": 1, "separators": 5}
#: (features other than zero, label)
PRIOR = [
    *[({**_NUMBER, "evidence": e}, int(e > 1)) for e in (1, 2, 3)], *[({**_SPELT, "evidence": e}, int(e > 1)) for e in (0, 2, 3)],
    *[({**_NUMBER, "glued": 1, "evidence": e}, 0) for e in (0, 1, 2, 3)],
]
PRIOR_ROWS = 10


def _strict(m: dict[str, Column]) -> dict[str, Column]:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    small = lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255"))
    return {
        "email": m["email"],
        "ip": F.filter(m["ip"], lambda x: F.forall(F.split(x["hit"], "\\."), small)),
        "card": F.filter(m["card"], lambda x: F.length(digits(x["hit"])).between(12, 19) & luhn(digits(x["hit"]))),
        "phone": F.filter(m["phone"], lambda x: F.length(digits(x["hit"])).between(9, 15)),
    }


def _found(docs: DataFrame, text: str) -> DataFrame:
    """`base`, and `wide`: candidates with their features and whether a strict span overlaps them."""
    rows = with_matches(docs, text, STRICT | WIDE, NEEDS)
    strict = _strict({k: F.col(k) for k in STRICT})
    rows = rows.withColumn("base", all_of([tagged(strict[k], k, KINDS.index(k)) for k in STRICT]))

    def described(kind: str) -> Column:
        # Steps of their own, so that no costly part is written out more than once.
        noted = bound(edges(F.col("base")), lambda e: F.transform(F.col(kind), lambda m: F.struct(
            m.alias("m"), digits(m["hit"]).alias("number"), meets(m, e).alias("strict"))))
        noted = F.transform(noted, lambda x: F.struct(
            *[x["m"][c].alias(c) for c in ("start", "end", "hit", "before", "after")], x["strict"].alias("strict"), F.length(x["number"]).alias("n"),
            F.when(F.length(x["number"]).between(12, 19), luhn(x["number"])).otherwise(False).alias("checked")))
        return F.transform(noted, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind"),
            m["strict"].alias("strict"), m["n"].alias("n"),
            *[v.alias(k) for k, v in _features(m, kind).items()]))

    return rows.withColumn("wide", F.concat(*[described(k) for k in WIDE])).drop(*STRICT, *WIDE)


class Trees:
    """Boosted trees of depth two over whole-numbered features, fitted to weighted combinations."""

    def __init__(self) -> None:
        self.base, self.trees = 0.0, []
        #: The least accepted sums of candidates without and with evidence.
        self.least = {False: math.inf, True: math.inf}

    def total(self, cell: dict) -> float:
        total = self.base
        for (f, t), sides in self.trees:
            g, u, values = sides[int(cell[f] >= t)]
            total += values[int(cell[g] >= u)]
        return total

    def accepts(self, cell: dict) -> bool:
        return self.total(cell) >= self.least[cell["evidence"] > 0]

    def fit(self, cells: list[dict]) -> None:
        n, positive = sum(c["n"] for c in cells), sum(c["positives"] for c in cells)
        self.base = math.log((positive + 0.5) / (n - positive + 0.5))
        for _ in range(ROUNDS if cells else 0):
            for c in cells:
                p = 1 / (1 + math.exp(-self.total(c)))
                c["g"], c["h"] = c["positives"] - c["n"] * p, c["n"] * p * (1 - p)
            root = _best_split(cells)
            sides = []
            for high in (False, True):
                own = [c for c in cells if (c[root[0]] >= root[1]) == high]
                best = _best_split(own)
                halves = [[c for c in own if (c[best[0]] >= best[1]) == x] for x in (False, True)]
                sides.append((*best, tuple(RATE * _step(x) for x in halves)))
            self.trees.append((root, sides))

    def calibrate(self, cells: list[dict], evidence: bool) -> None:
        """The bound lies halfway between the last sum accepted and the first refused."""
        n = positive = 0
        scored = sorted(((self.total(c), c["n"], c["positives"]) for c in cells), reverse=True)
        for i, (total, size, hits) in enumerate(scored):
            n, positive = n + size, positive + hits
            following = scored[i + 1][0] if i + 1 < len(scored) else total - 1
            if following < total and positive >= PRECISION * n:
                self.least[evidence] = (total + following) / 2

    def expression(self, x: Column) -> Column:
        """The sum of the trees for a struct of features."""
        total = F.lit(self.base)
        for (f, t), sides in self.trees:
            low, high = (F.when(x[g] >= u, v[1]).otherwise(v[0]) for g, u, v in sides)
            total = total + F.when(x[f] >= t, high).otherwise(low)
        return total


def _best_split(cells: list[dict]) -> tuple[str, int]:
    """The (feature, bound) that gains most, the first as listed of equal ones."""
    best, found = -1.0, (FEATURES[0], 1)
    for f, bound in BOUNDS.items():
        g, h = [0.0] * bound, [0.0] * bound
        for c in cells:
            g[c[f]] += c["g"]
            h[c[f]] += c["h"]
        for t in range(1, bound):
            gain = sum(sum(g[x]) ** 2 / (sum(h[x]) + 1.0) for x in (slice(0, t), slice(t, None)))
            if gain > best + 1e-9:
                best, found = gain, (f, t)
    return found


def _step(cells: list[dict]) -> float:
    return sum(c["g"] for c in cells) / (sum(c["h"] for c in cells) + 1.0)


def fitted(rows: list[dict]) -> Trees:
    """From sums (half, features, n, positives) of labelled candidates."""
    prior = [dict.fromkeys(FEATURES, 0) | known | {"half": half, "n": PRIOR_ROWS, "positives": PRIOR_ROWS * label}
             for half in (0, 1) for known, label in PRIOR]
    rows = sorted(rows, key=lambda r: [r[f] for f in FEATURES])
    hidden = [r | dict.fromkeys(HIDDEN, 0) for r in rows]
    trees = Trees()
    trees.fit([dict(r) for r in [*prior, *rows, *hidden] if r["half"] == 0])
    trees.calibrate([r for r in [*prior, *rows] if r["half"] == 1 and r["evidence"] > 0], True)
    trees.calibrate([r for r in [*prior, *hidden] if r["half"] == 1 and not r["evidence"]], False)
    return trees


def _labelled(docs: DataFrame, text: str) -> DataFrame:
    """(half, positive, features) of the candidates that evidence labels."""
    found = _found(docs.select(F.col(text).alias("text")), "text")
    half = F.pmod(F.xxhash64("text"), F.lit(2)).alias("half")
    # A plain explode puts a filter by the array's size in front of the matching, which is then done twice.
    each = found.select(half, "wide").select("half", F.explode_outer("wide").alias("w")).filter("w IS NOT NULL")
    return each.select("half", _label(F.col("w")).alias("positive"), *[F.col(f"w.{f}").alias(f) for f in FEATURES]).filter("positive IS NOT NULL")


def fit(docs: DataFrame, text: str = "text") -> Trees:
    cells = _labelled(docs, text).groupBy("half", *FEATURES).agg(F.count("*").alias("n"), F.sum("positive").alias("positives"))
    return fitted([r.asDict() for r in cells.collect()])  # at most 2 * CELLS rows


def _within(a: Column, others: Column) -> Column:
    """Whether span `a` lies in one of those with the `edges` others, which do not overlap."""
    return F.coalesce(F.get(others["ends"], count_upto(others["starts"], a["start"]) - 1) >= a["end"], F.lit(False))


def _outermost(spans: Column) -> Column:
    """The candidates that lie in none of the other generator, without what was noted of them."""
    def of(kind: str) -> Column:
        own, others = F.filter(spans, lambda s: s["kind"] == kind), F.filter(spans, lambda s: s["kind"] != kind)
        return bound(edges(others), lambda e: F.filter(own, lambda s: ~_within(s, e)))

    return F.transform(F.concat(*[of(k) for k in WIDE]), lambda s: F.struct(*[s[c].alias(c) for c in SPAN]))


def find_pii(docs: DataFrame, keep: Sequence[str], text: str = "text", trees: Trees | None = None) -> DataFrame:
    """The columns `keep` of every document with `base` and `spans`, arrays of (start, place, end,
    kind) in code points, end exclusive, sorted by start and then kind."""
    keep = [c for c in keep if c not in RESULT]
    if trees is None:
        trees = fit(docs, text)
        released(docs.sparkSession)
    rows = docs.select(*[quoted(c).alias(f"keep_{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    rows = _found(rows, "text")
    least = {k: F.lit(v) for k, v in trees.least.items()}
    scored = F.transform(F.filter("wide", lambda w: ~w["strict"]), lambda w: F.struct(
        *[w[c].alias(c) for c in (*SPAN, "evidence")], trees.expression(w).alias("score")))
    accepted = F.filter(scored, lambda w: w["score"] >= F.when(w["evidence"] > 0, least[True]).otherwise(least[False]))
    added = bound(accepted, _outermost)
    spans = F.when(F.size("wide") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", added)))
    return rows.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "base", spans.alias("spans"))


def _runs(spans: Column) -> Column:
    """Runs of overlapping sorted spans, each with the kind of its first.

    A run begins where as many spans have ended as began before. Where the next one begins, the ends so far
    are exactly those of the spans so far.
    """
    def of(ends: Column) -> Column:
        numbered = F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), i.alias("i")))
        first = F.filter(numbered, lambda s: count_upto(ends, s["start"]) == s["i"])
        return bound(first, lambda f: F.transform(f, lambda s, k: F.struct(
            s["start"].alias("start"), F.get(ends, F.coalesce(F.get(f, k + 1)["i"], F.size(ends)) - 1).alias("end"), s["kind"].alias("kind"))))

    return bound(F.array_sort(F.transform(spans, lambda s: s["end"])), of)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by its first kind in brackets.

    The text is cut into pieces, so that no span is looked for from the text's beginning.
    """
    def in_piece(piece: Column, low: Column, runs: Column) -> Column:
        def upto(r: Column, i: Column) -> Column:
            begin = F.greatest(low, F.get(runs, i - 1)["end"])
            label = F.when(r["start"] >= low, F.concat(F.lit("["), F.upper(r["kind"]), F.lit("]"))).otherwise("")
            return F.concat(F.substr(piece, begin - low + 1, F.greatest(r["start"] - begin, F.lit(0))), label)

        last = F.substr(piece, F.greatest(F.get(runs, F.size(runs) - 1)["end"] - low, F.lit(0)) + 1)
        return F.when(F.size(runs) == 0, piece).otherwise(F.concat(F.array_join(F.transform(runs, upto), ""), last))

    def whole(x: Column) -> Column:
        def cut(piece: Column, k: Column) -> Column:
            low = k * PIECE
            before, begun = count_upto(x["edges"]["ends"], low), count_upto(x["edges"]["starts"], low + (PIECE - 1))
            return bound(before, lambda n: bound(F.slice(x["runs"], n + 1, begun - n), lambda runs: in_piece(piece, low, runs)))
        return F.array_join(F.transform(x["pieces"], cut), "")

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))
    joined = bound(_runs(spans), lambda r: bound(F.struct(pieces.alias("pieces"), r.alias("runs"), edges(r).alias("edges")), whole))
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of every document, personal data in the text replaced."""
    own = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*own.values())
    found = find_pii(rows, list(own.values()), text=own[text])
    found = found.withColumn(own[text], redacted(F.col(own[text]), F.col("spans")))
    return found.select(*[F.col(v).alias(c) for c, v in own.items()])

