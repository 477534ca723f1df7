"""Secret scan: candidate strings judged by a random forest, in SQL expressions.

A candidate is a run of 16 or more key characters with a digit in it ('=' only
as padding at its end, so that key=value is cut at it), or whatever value, long
or short, with digits or without, stands after an assignment to a credential
word, an authorization scheme or a user name in a URL.  Every text is split at its candidates, so that each one has the words to its left and
right at hand, and the forest's features are computed where it stands: length,
character classes and their transitions, distinct characters, the share that
dictionary words cover, path separators, the kind of path the text comes from,
and the neighbouring words.  The trees are written as nested CASE expressions:
one projection without shuffles or Python, whose memory is that of a text.

The forest is grown from labelled findings (candidate, left, right, path,
label) of all texts: their features are rounded to levels, Spark counts the
findings of each combination of levels, and for every depth of the trees the
tasks add up one histogram per open node; only these, whose size does not depend
on the findings, reach the driver.  ``labelled_findings`` labels the findings of
every text by evidence that the features do not hold: values in a
known key format are true wherever they stand, assigned ones where their entropy
is that of a random value; other candidates are false where they do not look
random, and left out where they do (nobody knows).  Findings of both labels are
made as well, since a corpus may hold few: random values and known formats, and
values of ordinary words, in several kinds of assignment and in prose, and
placeholders in a key format that a text shows as an example.  Whether a value has a known format is
one of the features; the forest alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import forget, free_names, written

_PADDING = r"""(?:={1,2}(?![A-Za-z0-9+/_.=-]|["'`][A-Za-z0-9+/_.-]))?"""
_ASSIGNED = (r"""(?:(?:token|key|secret|pass|pwd|auth|bearer|credential)[a-z0-9_-]{0,40}["']?\]?\s{0,3}[:=]{1,2}>?\s{0,3}["'`]?"""
             r"""|auth[a-z]{0,12}["']?\s{0,3}[:=]\s{0,3}["'`]?(?:bearer|basic|token)\s{1,3})""")
_USER = r"://[^\s/:@]{1,32}:"
_PEM = (r"-----BEGIN (?:[A-Z0-9]{2,12} ){0,3}PRIVATE KEY(?: BLOCK)?-----[^-]*+(?:-(?!-)[^-]*+)*+"
        r"(?:-----END (?:[A-Z0-9]{2,12} ){0,3}PRIVATE KEY(?: BLOCK)?-----)?")
#: Published key formats: private key blocks, cloud, code hosting, chat and payment keys, JSON web tokens.
KNOWN = (r"(?<![0-9A-Za-z])(?:" + _PEM + r"|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[oprsu]_[0-9A-Za-z]{36,255}|github_pat_[0-9A-Za-z_]{60,255}|glpat-[0-9A-Za-z_-]{20,}"
         r"|xox[abeoprs]-[0-9A-Za-z-]{10,}|[rs]k_(?:live|test)_[0-9A-Za-z]{16,}|sk-[0-9A-Za-z_-]{32,}|AIza[0-9A-Za-z_-]{35}"
         r"|npm_[0-9A-Za-z]{36}|SG\.[0-9A-Za-z_-]{16,}\.[0-9A-Za-z_-]{16,}"
         r"|eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}(?:\.[0-9A-Za-z_-]*)?)")
#: In this order: the value of an assignment (up to its quote, or the plain word), of a URL's user, the
#: long run, and a known key without a digit.  The short look-behinds in front spare the long ones at
#: most places, and the first one all of them inside words.
CANDIDATE = (r"""(?<![A-Za-z0-9])(?:(?<![+/_.-])(?:(?:(?<=[:=>"'`]|[:=>cnrCNR]\s{1,3})(?<=(?i:""" + _ASSIGNED + r"""))"""
             r"""(?!(?i:bearer|basic|token)\s)(?:(?<=["'`])[^\s"'`]++(?=["'`])"""
             r"""|[^\s"'`<>&,;=:](?:[^\s"'`<>&,;=]*[^\s"'`<>&,;=.:)\]}])?""" + _PADDING + ")"
             r"""|(?<=:)(?<=""" + _USER + r""")[^\s/@"'`]++(?=@))"""
             r"|(?=[A-Za-z+/_.-]*[0-9])[A-Za-z0-9+/_.-]{15,}[A-Za-z0-9+/_-]" + _PADDING + ")"
             + "|(?=[ASegnrsx-])" + KNOWN + ")")
CREDENTIAL = r"(?i)(?:" + _ASSIGNED + r"|bearer\s{1,3}|" + _USER + ")$"
ENTROPY = 2.5               # bits a character, of a value that counts as random
THRESHOLD = 0.5
CONTEXT = 48                # characters of text seen on either side
#: What stands before and after a made value.
ASSIGNMENTS = ((' token = "', '" '), (" password: ", " "), ("_API_KEY=", "\n"), (' {"client_secret": "', '", '),
               (" https://host/path?access_token=", "&page=2 "), (' "Authorization: Bearer ', '" '), (" passwd='", "' "),
               (" https://user:", "@host/ "), (" export SECRET=", " "), (" auth_key => '", "', "))
DICTIONARY = 1500           # frequent words of the texts that count as dictionary
TREES, DEPTH, LEAF = 25, 5, 5
FOLDS = 5                   # every tree leaves out one of so many folds of the findings
LEVELS = 32                 # levels of a feature in the fit
SHARE = 20                  # steps that shares are rounded up to
MASK = "[SECRET]"
_MARK = "\ue000"

TRANSITION = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"

FEATURES = ("length", "digits", "upper", "transitions", "distinct", "dictionary", "separators",
            "test_path", "credential", "quoted", "address", "known", "placeholder", "example", "prose")

#: Words of made-up values, and of texts that show one.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|1234567|(.)\1{5}"
SHOWN = r"(?i)\b(?:examples?|e\.g|docs?|documentation|samples?|placeholder|dummy|fake|tutorial)\b"


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def features(value: Column, left: Column, right: Column, path: Column, dictionary: Column) -> list[Column]:
    """The features named in FEATURES, as doubles."""
    size = F.greatest(F.length(value), F.lit(1))
    parts = F.filter(F.split(F.lower(value), "[^a-z]+"), lambda w: (F.length(w) >= 3) & F.array_contains(dictionary, w))
    flags = [F.coalesce(x, F.lit(False)).cast("double") for x in (
        path.rlike(r"(?i)(^|[/_.-])(tests?|examples?|samples?|docs?|fixtures?)([/_.-]|$)"),
        left.rlike(CREDENTIAL), left.rlike(r"[\"'`]$"), left.rlike(r"[@/]$") | right.rlike(r"^[@/:]"),
        value.rlike(KNOWN), value.rlike(PLACEHOLDER), left.rlike(SHOWN) | right.rlike(SHOWN))]
    return [F.length(value).cast("double"),
            _count(value, "[0-9]") / size, _count(value, "[A-Z]") / size,
            _count(value, TRANSITION) / size,
            F.size(F.array_distinct(F.split(value, ""))) / size,
            F.aggregate(parts, F.lit(0), lambda n, w: n + F.length(w)) / size,
            _count(value, "[/.]") / size, *flags,
            _count(left, r"[a-z]{2,}").cast("double")]


def _level(name: str, value: Column) -> Column:
    """A feature rounded up to one of LEVELS levels."""
    if name == "length":
        level = F.ceil(F.log2(F.greatest(value, F.lit(1.0))) * 3)
    elif name == "prose":
        level = F.ceil(value)
    else:
        level = F.ceil(value * SHARE)
    return F.least(level, F.lit(LEVELS - 1)).cast("int")


def _cut(name: str, level: int) -> float:
    """The greatest value of a feature that has this level."""
    return 2 ** (level / 3) if name == "length" else float(level) if name == "prose" else level / SHARE


@dataclass
class _Tree:
    """A tree in the making: feature (-1: a leaf), level, children and
    probability of each node, and the nodes that are still open."""

    feature: list
    level: list
    low: list
    high: list
    p: list
    open: list

    def place(self, at: int = 0) -> str:
        """SQL for the number of the open node that a row of ``levels`` is in, or -1."""
        if self.feature[at] < 0:
            return str(self.open.index(at) if at in self.open else -1)
        return (f"CASE WHEN get(levels, {self.feature[at]}) <= {self.level[at]} THEN {self.place(self.low[at])}"
                f" ELSE {self.place(self.high[at])} END")

    def nested(self, at: int = 0):
        """The tree as nested (feature, threshold, low, high) tuples."""
        f = self.feature[at]
        if f < 0:
            return float(self.p[at])
        return f, _cut(FEATURES[f], self.level[at]), self.nested(self.low[at]), self.nested(self.high[at])


def _histograms(cells: DataFrame, trees: list[_Tree], chosen: list) -> np.ndarray:
    """Findings by tree, open node, feature (of the node's ``chosen`` ones), level and label."""
    at = ", ".join(f"CASE WHEN fold = {t % FOLDS} THEN -1 ELSE {tree.place()} END" for t, tree in enumerate(trees))
    def literal(x) -> str:
        return f"array({', '.join(map(literal, x))})" if isinstance(x, list) else str(x)
    rows = (cells.select("label", "n", "levels", F.expr(f"posexplode(array({at})) as (tree, node)")).where("node >= 0")
            .select("tree", "node", "label", "n", F.expr(
                f"inline(transform(get(get({literal(chosen)}, tree), node), f -> struct(f, get(levels, f) as level)))")))
    sums = rows.groupBy("tree", "node", "f", "level", "label").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(trees), max(len(t.open) for t in trees), len(FEATURES), LEVELS, 2))
    out[tuple(sums.column(i).to_numpy() for i in range(5))] = sums.column("n").to_numpy()
    return out


def _split(counts: np.ndarray, weight: np.ndarray, chosen: list[int]):
    """The best (feature, level) of the chosen features, or None.

    ``counts``: findings by feature, level and label."""
    at = None
    whole = counts[chosen[0]].sum(axis=0)
    if whole.sum() < 2 * LEAF or not whole.all():
        return None
    gini = lambda c: (c[..., 0] * c[..., 1]) / np.maximum(c.sum(axis=-1), 1e-9)
    best = gini(whole * weight) * (1 - 1e-9)
    for f in chosen:
        low = counts[f].cumsum(axis=0)
        high = whole - low
        cost = gini(low * weight) + gini(high * weight)
        cost[(low.sum(axis=1) < LEAF) | (high.sum(axis=1) < LEAF)] = np.inf
        level = int(cost.argmin())
        if cost[level] < best:
            best, at = cost[level], (f, level)
    return at


def grow(cells: DataFrame, weight: np.ndarray, seed: int = 7) -> list:
    """Trees as nested (feature, threshold, low, high) tuples with probability
    leaves, from ``cells`` (levels, label, fold, n): each leaves out a fold of
    the findings; random thirds of the features, Gini splits.  One pass over
    the cells for each depth; ``weight`` is that of a finding of either label."""
    rng = np.random.default_rng(seed)
    trees = [_Tree([-1], [0], [0], [0], [0.5], [0]) for _ in range(TREES)]
    for depth in range(DEPTH + 1):
        if not any(t.open for t in trees):
            break
        some = len(FEATURES) // 3 + 1 if depth < DEPTH else 1
        chosen = [[rng.permutation(len(FEATURES))[:some].tolist() for _ in t.open] for t in trees]
        chosen = [c or [[0]] for c in chosen]       # an array of arrays in any case
        for tree, counts, picks in zip(trees, _histograms(cells, trees, chosen), chosen):
            todo, tree.open = tree.open, []
            for node, here, pick in zip(todo, counts, picks):
                total = here[pick[0]].sum(axis=0) * weight
                if total.sum():
                    tree.p[node] = total[1] / total.sum()
                split = _split(here, weight, pick) if depth < DEPTH else None
                if split is not None:
                    tree.feature[node], tree.level[node] = split
                    tree.low[node], tree.high[node] = (len(tree.feature) + i for i in (0, 1))
                    tree.open += [tree.low[node], tree.high[node]]
                    for values, v in ((tree.feature, -1), (tree.level, 0), (tree.low, 0), (tree.high, 0), (tree.p, tree.p[node])):
                        values += [v, v]
    return [t.nested() for t in trees]


@dataclass(frozen=True)
class Forest:
    """Grown trees and the dictionary their features use."""

    trees: list
    dictionary: list[str]

    def sql(self, row: str) -> str:
        """SQL for the mean of the trees over the fields of struct ``row``."""
        def node(t) -> str:
            if isinstance(t, float):
                return f"{t!r}D"
            return f"CASE WHEN {row}.{FEATURES[t[0]]} <= {t[1]!r}D THEN {node(t[2])} ELSE {node(t[3])} END"
        return "(" + " + ".join(node(t) for t in self.trees) + f") / {len(self.trees)}D"


def _parts(text: Column) -> Column:
    """A text cut at its candidates: what stands before the first one, it, what
    stands behind it, and so on.  One search: candidates are put between marks;
    a text that has the mark itself is searched twice instead."""
    text = F.coalesce(text, F.lit(""))
    values, gaps = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)
    twice = F.flatten(F.zip_with(gaps, values, lambda g, v: F.when(v.isNull(), F.array(g)).otherwise(F.array(g, v))))
    marked = F.split(F.regexp_replace(text, CANDIDATE, _MARK + "$0" + _MARK), _MARK, -1)
    return F.when(F.contains(text, F.lit(_MARK)), twice).otherwise(marked)


def _between(parts: Column) -> tuple[Column, Column]:
    """The candidates among the parts of a text, and what stands between them (one more)."""
    return F.filter(parts, lambda _, i: i % 2 == 1), F.filter(parts, lambda _, i: i % 2 == 0)


def _with_context(text: Column) -> tuple[Column, Column]:
    """The candidates of a text and what stands between them (one more)."""
    return _between(_parts(text))


def _tail(text: Column, n: int) -> Column:
    return F.substring(text, -n, n)


def _left(values: Column | str, gaps: Column | str, i: Column) -> Column:
    """What stands before candidate i.  The candidate before it belongs to it:
    a long key with a digit is one, and its value the next."""
    before = F.when(i > 0, F.get(values, i - 1))
    return _tail(F.concat(F.coalesce(before, F.lit("")), F.get(gaps, i)), CONTEXT)


def labelled_findings(docs: DataFrame, text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(value, left, right, path, label) of every text of ``docs``."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    has = docs.select(F.col(text_col).alias("text"), path.alias("path")).where("text is not null")
    values, gaps = _between(F.col("p"))
    real = (has.select("path", _parts(F.col("text")).alias("p")).where(F.size("p") > 1)
            .select("path", values.alias("v"), gaps.alias("g"))
            .select("path", "g", "v", F.posexplode("v").alias("i", "value"))
            .select("value", _left("v", "g", F.col("i")).alias("left"),
                    F.substring(F.get("g", F.col("i") + 1), 1, CONTEXT).alias("right"), "path")
            .withColumn("label", _label(F.col("value"), F.col("left"))).where("label is not null"))
    words = F.filter(F.split(F.col("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 2)
    made = (has.select("path", F.slice(words, 1, 100).alias("w"), F.sha2("text", 256).alias("digest"))
            .where("size(w) > 8").select("path", F.explode(_made(F.col("w"), F.col("digest"))).alias("x"))
            .select("x.value", "x.left", "x.right", "path", "x.label"))
    return real.unionAll(made)


def _random(value: Column) -> Column:
    """Whether a value looks random: by the entropy of its characters, and by
    letters, digits and cases that keep changing."""
    chars = F.split(F.substring(value, 1, 64), "")
    n = F.size(chars)
    share = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    bits = F.aggregate(share, F.lit(0.0), lambda h, p: h - p * F.log2(p))
    return (bits >= ENTROPY) & (_count(value, TRANSITION) >= 3)


def _label(value: Column, left: Column) -> Column:
    """1 for a known key format and an assigned value that looks random, 0 for
    an unassigned one that does not and for a placeholder, null for any other."""
    return (F.when(value.rlike(PLACEHOLDER), 0)
            .when(value.rlike(KNOWN) | (left.rlike(CREDENTIAL) & _random(value)), 1)
            .when(~left.rlike(CREDENTIAL) & ~_random(value), 0))


def _made(w: Column, digest: Column) -> Column:
    """Made findings of one text, by its words and digest: secrets and ordinary values after assignments,
    a known format, an ordinary value and a host or path of no words in prose."""
    def pick(salt: int, *choices: Column) -> Column:
        return F.get(F.array(*choices), F.pmod(F.xxhash64(F.lit(salt), digest), F.lit(len(choices))).cast("int"))

    word = lambda i: F.get(w, F.lit(i))
    number = F.pmod(F.xxhash64(F.lit(1), digest), F.lit(9000)).cast("string")
    code = F.regexp_replace(F.concat(F.base64(F.unhex(digest)), F.base64(F.unhex(F.sha2(digest, 256)))), "[^A-Za-z0-9]", "")
    letters = F.translate(F.upper(F.substring(digest, 1, 16)), "0123456789", "GHIJKLMNOP")
    known = pick(2, F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 1, 16))), F.concat(F.lit("AKIA"), letters), F.concat(F.lit("ghp_"), F.substring(code, 1, 36)),
                 F.concat(F.lit("eyJ"), F.substring(code, 1, 20), F.lit(".eyJ"), F.substring(code, 21, 40)),
                 F.concat(F.lit("sk_live_"), F.substring(code, 1, 24)))
    mixed = F.concat(F.substring(word(1), 1, 6), number, F.substring(word(4), 1, 6), number)
    secret = pick(3, F.substring(digest, 1, 40), F.substring(digest, 1, 32), F.substring(code, 1, 40),
                  F.substring(code, 1, 20), F.substring(code, 1, 12), mixed, known)
    plain = [F.concat_ws("_", word(1), word(4), word(6), (F.size(w) % 100).cast("string")), word(1),
             F.concat_ws("-", word(1), word(4)), F.concat(F.lit("${"), F.upper(word(1)), F.lit("}")),
             F.concat_ws("/", word(1), word(4), word(6)), F.concat_ws(".", word(1), word(4))]
    odd = lambda i: F.concat(F.substring(word(i), 1, 4), F.substring(word(i + 1), 1, 3))
    digit = F.pmod(F.xxhash64(F.lit(10), digest), F.lit(10)).cast("string")
    place = pick(11, F.concat(odd(1), digit, F.lit("."), odd(3), F.lit(".com")),
                 F.concat(odd(1), F.lit("."), odd(3), F.lit(".org/"), odd(5), digit, F.lit("/"), odd(2)),
                 F.concat_ws("/", odd(1), odd(3), F.concat(odd(5), digit)))
    prose = F.struct(F.concat_ws(" ", word(3), word(5), word(0), F.lit("")).alias("left"),
                     F.concat(F.lit(" "), word(2)).alias("right"))
    forms = [F.struct(F.concat(word(0), F.lit(a)).alias("left"), F.concat(F.lit(b), word(2)).alias("right"))
             for a, b in ASSIGNMENTS]
    shown = pick(12, F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 1, 9)), F.lit("EXAMPLE")),
                 F.concat(F.lit("ghp_"), F.repeat(F.lit("x"), 36)),
                 F.concat(F.lit("sk_test_your"), number, F.lit("key0goes0here")))
    text = [F.struct(F.concat(word(0), F.lit(a)).alias("left"), F.concat(F.lit(b), word(2)).alias("right"))
            for a, b in ((" in the docs example ", " "), (" for example: ", " "), (" e.g. ", " (sample) "),
                         (' example_key = "', '" # placeholder '))]
    rows = ((secret, pick(4, *forms), 1), (known, prose, 1), (shown, pick(13, *text), 0),
            (pick(5, *plain), pick(6, *forms), 0),
            (pick(7, *plain), pick(8, *forms), 0),
            (pick(9, F.concat(number, number, number, number), *plain), prose, 0), (place, prose, 0))
    return F.array(*[F.struct(value.alias("value"), around["left"].alias("left"), around["right"].alias("right"),
                              F.lit(label).alias("label")) for value, around, label in rows])


def fit(findings: DataFrame, words: DataFrame | None = None, text_col: str = "text") -> Forest:
    """Forest from all labelled findings, either label weighing the same in
    all.  Without findings of both labels every candidate is flagged, so that
    nothing is missed.  The dictionary holds the words that most texts of
    ``words`` have."""
    dictionary: list[str] = []
    if words is not None:
        each = words.select(F.explode(F.array_distinct(F.split(F.lower(text_col), "[^a-z]+"))).alias("word"))
        dictionary = [r.word for r in each.where("length(word) >= 3").groupBy("word").count()
                      .orderBy(F.desc("count"), "word").limit(DICTIONARY).collect()]
    cols = features(*(F.col(c) for c in ("value", "left", "right", "path")), _literal(dictionary))
    fold = F.pmod(F.xxhash64(F.lit(17), "value", "left"), F.lit(FOLDS)).cast("int")
    known = findings.select("label", fold.alias("fold"), F.array(*[_level(n, c) for c, n in zip(cols, FEATURES)]).alias("levels"))
    cells = written(known.groupBy("label", "fold", "levels").agg(F.count(F.lit(1)).alias("n")), "findings")
    seen = {r.label: r.n for r in cells.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    trees = [1.0]
    if len(seen) == 2:
        trees = grow(cells, np.array([1 / seen[0], 1 / seen[1]]) * sum(seen.values()) / 2)
    forget(cells)
    return Forest(trees, dictionary)


def _literal(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def scan(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str | None = None,
         threshold: float = THRESHOLD, names: tuple[str, str, str] = ("n_candidates", "secrets", "redacted")) -> DataFrame:
    """``docs`` with three columns more (``names`` gives them others): ``n_candidates``, ``secrets`` (place,
    length and score of every candidate of at least ``threshold``, in text
    order) and ``redacted`` (the text with those masked; null stays null).

    Empty and null texts have no candidates; repeated rows are scanned each;
    a column of ``docs`` that has one of these three names is replaced, any
    other is kept as it is.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    known = _literal(forest.dictionary)
    v, g, f, s, e, p = free_names(docs, 6, names)
    values, gaps = _between(F.col(p))

    def described(value: Column, i: Column) -> Column:
        left, right = _left(v, g, i), F.substring(F.get(g, i + 1), 1, CONTEXT)
        return F.struct(*[c.alias(n) for c, n in zip(features(value, left, right, path, known), FEATURES)])

    rows = (docs.withColumn(p, _parts(F.col(text_col))).withColumns({v: values, g: gaps}).drop(p)
            .withColumn(f, F.transform(v, described))
            .withColumn(s, F.expr(f"transform({f}, x -> {forest.sql('x')})")))
    ends = F.aggregate(F.arrays_zip(F.transform(g, lambda x: F.length(x)).alias("g"),
                                    F.transform(v, lambda x: F.length(x)).alias("v")),
                       F.array(F.lit(0)),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["g"] + F.coalesce(x["v"], F.lit(0)))))
    found = F.transform(v, lambda x, i: F.struct(
        (F.get(e, i) + F.length(F.get(g, i))).alias("at"), F.length(x).alias("length"),
        F.get(s, i).alias("score")))
    masked = F.array_join(F.transform(g, lambda x, i: F.concat(
        x, F.when(F.get(s, i) >= threshold, MASK).otherwise(F.coalesce(F.get(v, i), F.lit(""))))), "")
    return (rows.withColumn(e, ends)
            .withColumns(dict(zip(names, (F.size(v), F.filter(found, lambda x: x["score"] >= threshold),
                                          F.when(F.col(text_col).isNotNull(), masked)))))
            .drop(v, g, f, s, e))
