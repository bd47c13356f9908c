"""Personal data by weak supervision: fixed patterns, plus candidates that labelers vote on.

DataFrame functions only. Labelers (form, gazetteer, context before and after, standing alone) vote for, against or
not at all on every candidate. Expectation-maximisation over the table of vote patterns, which has a row per pattern
and never per candidate, estimates how reliable each labeler is; its posteriors train a logistic classifier over kind
and votes, which is compiled into a column.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.session import materialise

# Fixed patterns. Repeated groups are possessive, so that the engine loops over them instead of descending; a match
# starts where its run of characters starts or the previous match ended, so that no run is tried at each character.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

_WORD = "[A-Z][a-z]{1,30}(?![A-Za-z])"

# Candidates that labelers vote on.
CANDIDATES = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    # One word is consumed and the rest looked ahead at, so that a name is tried at every capitalised word: group 1 is the
    # rest of the name, group 2 what stands after it.
    "name": rf"(?<![A-Za-z])(?:(?:Mr|Mrs|Ms|Dr|Prof)\.|{_WORD})\x20(?=((?:(?<=\.\x20){_WORD}\x20)?{_WORD})((?s:.{{0,10}})))",
}
KINDS = [*BASE, *CANDIDATES]

# Gazetteers: given names that are common in English, country codes of bank accounts.
GIVEN_NAMES = "James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Daniel Paul Mark George Anna Emma Laura Maria Peter Andrew".split()
ACCOUNT_COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MT NL NO PL PT RO SE SI SK".split()

_CONTEXT = {
    "iban": r"(?i)iban|account|bank|konto|cuenta|compte",
    "ssn": r"(?i)ssn|social\s+security|tax\s*(?:id|number)",
    "local_phone": r"(?i)phone|tel|call|mobile|fax|contact",
    "name": r"(?i)name|contact|signed|author|dear|regards|patient|mr\.|mrs\.",
}
_AGAINST = r"(?i)(?:version|build|isbn|part|order|serial|model|invoice|sku|no\.|#)\W{0,3}$"
LABELERS = ("form", "gazetteer", "context", "against", "alone")


def _found(kind: str, pattern: str) -> Column:
    """All matches with the length of the gap before each and the text around it; nothing is built where none is."""
    every = lambda group: F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    ahead = kind == "name"
    pieces = F.struct(F.split("text", pattern).alias("gaps"), every(0).alias("hits"), *([every(1).alias("rest"), every(2).alias("after")] if ahead else []))

    def row(p: Column, hit: Column, k: Column) -> Column:
        gap = F.get(p["gaps"], k)
        if ahead:
            # Up to 12 matches before, of at least 3 characters each, belong to the text around a name.
            near = F.zip_with(F.slice(p["gaps"], F.greatest(k - 11, F.lit(1)), F.least(k, F.lit(12))), F.slice(p["hits"], F.greatest(k - 11, F.lit(1)), F.least(k, F.lit(12))), lambda g, h: F.concat(F.right(g, F.lit(40)), h))
            before, after, whole = F.right(F.concat(F.array_join(near, ""), F.right(gap, F.lit(40))), F.lit(40)), F.get(p["after"], k), F.concat(hit, F.get(p["rest"], k))
        else:
            before, after, whole = F.right(gap, F.lit(40)), F.left(F.get(p["gaps"], k + 1), F.lit(10)), hit
        return F.struct(F.lit(kind).alias("kind"), k.alias("k"), F.length(gap).alias("gap"), F.length(hit).alias("taken"), whole.alias("hit"), before.alias("before"), after.alias("after"))

    # The pieces are bound by a lambda, so the text is split once a pattern, not once a match.
    bound = F.transform(F.array(pieces), lambda p: F.transform(p["hits"], lambda hit, k: row(p, hit, k)))
    return F.when(F.col("text").rlike(pattern), F.get(bound, F.lit(0)))


def _pieces(texts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """All matches with their number among those of their kind, and the characters before and in each."""
    each = texts.select("doc_id", "text_hash", F.explode(F.flatten(F.array_compact(F.array(*(_found(k, p) for k, p in patterns.items()))))).alias("m"))
    return each.select("doc_id", "text_hash", "m.*", F.length("m.hit").alias("size"))


def _placed(pieces: DataFrame) -> DataFrame:
    """Add start_at and end_at (code points, end exclusive)."""
    each = pieces.dropDuplicates(["doc_id", "text_hash", "kind", "k"])  # rows that repeat
    before = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.col("taken")).over(before) - F.col("taken")
    return each.withColumn("start_at", start).withColumn("end_at", F.col("start_at") + F.col("size")).drop("k", "gap", "taken", "size")


def matches(texts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """doc_id, text_hash, kind, hit, start_at, end_at (code points, end exclusive), before, after of all matches."""
    return _placed(_pieces(texts, patterns)).select("doc_id", "text_hash", "kind", "hit", "start_at", "end_at", "before", "after")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the check sum."""
    n = F.length(digits)
    value = lambda k: F.substring(digits, n - k, F.lit(1)).cast("int")
    doubled = lambda v: F.when(v > 4, 2 * v - 9).otherwise(2 * v)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, k: s + F.when(k % 2 == 1, doubled(value(k))).otherwise(value(k)))
    return total % 10 == 0


def valid_base(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == "card", F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(False)
    )


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0) if no is not None else F.when(yes, 1).otherwise(0)


def _account_check(hit: Column) -> Column:
    """Whether a bank account number leaves 1 when divided by 97 (letters count 10 to 35)."""
    bare = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))
    digit = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise((s * F.when(digit(c) > 9, 100).otherwise(10) + digit(c)) % 97))
    return rest == 1


def votes(found: DataFrame) -> DataFrame:
    """Add a column per labeler: 1 for, -1 against, 0 no opinion."""
    kind, hit = F.col("kind"), F.col("hit")
    first = F.regexp_extract(hit, r"^(?:(?:Mr|Mrs|Ms|Dr|Prof)\. )?([A-Za-z]+)", 1)
    form = (
        F.when(kind == "iban", _vote(_account_check(hit), ~_account_check(hit)))
        .when(kind == "ssn", _vote(~hit.rlike("^(?:000|666|9..)|-00-|-0000$"), hit.rlike("^(?:000|666|9..)|-00-|-0000$")))
        .when(kind == "local_phone", _vote(hit.rlike(r"^\(?[2-9]"), hit.rlike(r"^\(?[01]")))
        .otherwise(_vote(hit.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\. ")))
    )
    gazetteer = (
        F.when(kind == "iban", _vote(F.left(hit, F.lit(2)).isin(ACCOUNT_COUNTRIES), ~F.left(hit, F.lit(2)).isin(ACCOUNT_COUNTRIES)))
        .when(kind == "name", _vote(first.isin(GIVEN_NAMES), ~first.isin(GIVEN_NAMES)))
        .otherwise(F.lit(0))
    )
    context = F.lit(0)
    for name, pattern in _CONTEXT.items():
        context = F.when(kind == name, _vote(F.col("before").rlike(pattern), ~F.col("before").rlike(pattern))).otherwise(context)
    alone = F.col("before").rlike(r"(?:^|[\s(\[{\"':;,])$") & F.col("after").rlike(r"^(?:$|[\s)\]}\"':;,.!?])")
    return found.withColumns({
        "form": form, "gazetteer": gazetteer, "context": context,
        "against": F.when(F.col("before").rlike(_AGAINST), -1).otherwise(0), "alone": F.when(alone, 0).otherwise(-1)})


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of true candidates, accuracy of each labeler when it votes, and the posterior of each vote pattern.

    Pseudo-counts of 20 votes at accuracy 0.8 and of 10 candidates at a share of 0.3 keep it stable on few candidates
    and stop the two classes from changing places.
    """
    share, accuracy = 0.3, np.full(patterns.shape[1], 0.8)
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        odds = math.log(share / (1 - share)) + (patterns * np.log(accuracy / (1 - accuracy))).sum(1)
        posterior = 1 / (1 + np.exp(-odds))
        share = (3 + (counts * posterior).sum()) / (10 + counts.sum())
        agree = np.where(patterns > 0, posterior[:, None], np.where(patterns < 0, 1 - posterior[:, None], 0))
        accuracy = np.clip((16 + (counts[:, None] * agree).sum(0)) / (20 + (counts[:, None] * (patterns != 0)).sum(0)), 0.55, 0.99)
    return share, accuracy, posterior


def train_classifier(kinds: list[str], patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray, rounds: int = 300) -> tuple[dict[str, float], np.ndarray]:
    """Logistic weights of kinds and votes, fitted to posteriors by gradient steps on pattern counts."""
    names = sorted(set(kinds))
    x = np.hstack([np.array([[k == n for n in names] for k in kinds], float), patterns])
    w, weight = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ (weight * (p - posterior)) + 1e-4 * w)
    return dict(zip(names, w[: len(names)].tolist(), strict=True)), w[len(names) :]


def classify(voted: DataFrame) -> DataFrame:
    """Candidates that the trained classifier takes for personal data (probability of at least one half).

    One aggregation gives the counts of at most kinds * 3^labelers patterns; training runs on those.
    """
    seen = [r.asDict() for r in voted.groupBy("kind", *LABELERS).count().collect()]
    if not seen:
        return voted.limit(0)
    patterns = np.array([[r[n] for n in LABELERS] for r in seen], float)
    counts = np.array([r["count"] for r in seen], float)
    _, _, posterior = estimate(patterns, counts)
    by_kind, weights = train_classifier([r["kind"] for r in seen], patterns, counts, posterior)
    odds = F.lit(0.0)
    for name, w in by_kind.items():
        odds = F.when(F.col("kind") == name, F.lit(w)).otherwise(odds)
    for name, w in zip(LABELERS, weights.tolist(), strict=True):
        odds = odds + F.col(name) * F.lit(w)
    return voted.filter(odds >= 0)


def whole_names(added: DataFrame) -> DataFrame:
    """Accepted candidates, with names that overlap joined to one span."""
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start_at", "end_at")
    reach = F.max("end_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    names = added.filter("kind = 'name'").withColumn("_begins", F.coalesce(F.col("start_at") >= reach, F.lit(True)))
    names = names.withColumn("_island", F.sum(F.col("_begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = names.groupBy("doc_id", "text_hash", "kind", "_island").agg(F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at")).drop("_island")
    return added.filter("kind <> 'name'").select(merged.columns).unionByName(merged)


def find_positions(docs: DataFrame) -> DataFrame:
    """All spans: doc_id, text_hash, kind, start_at, end_at, is_base.

    Fixed patterns whose matches are valid are base spans. Candidates are added where the classifier takes them and no
    base span overlaps; names that overlap are one span. Rows equal in doc_id and text count once; null texts have no spans.
    Matches are judged where they are found: neither they nor the text around them are shuffled or written.
    """
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    judged = votes(_pieces(texts, BASE | CANDIDATES)).withColumn("valid", valid_base(F.col("kind"), F.col("hit"))).drop("hit", "before", "after")
    found = materialise(_placed(judged), "matches")
    base = found.filter("valid").withColumn("is_base", F.lit(True))
    added = whole_names(classify(found.filter(F.col("kind").isin(*CANDIDATES)))).withColumn("is_base", F.lit(False))
    columns = ["doc_id", "text_hash", "kind", "start_at", "end_at", "is_base"]
    both = base.select(columns).unionByName(added.select(columns))
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start_at", F.desc("is_base"))
    earlier = F.max(F.when(F.col("is_base"), F.col("end_at"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(F.col("is_base"), F.col("start_at"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    return both.withColumns({"_earlier": earlier, "_later": later}).filter(
        F.col("is_base") | ((F.coalesce("_earlier", F.lit(-1)) <= F.col("start_at")) & (F.coalesce(F.col("_later"), F.col("end_at")) >= F.col("end_at")))).drop("_earlier", "_later")


def find_spans(docs: DataFrame) -> DataFrame:
    """The spans of ``find_positions`` with the matched text as ``hit``."""
    spans = find_positions(docs)
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("_doc_id"), F.xxhash64("text").alias("_hash"), "text").dropDuplicates(["_doc_id", "_hash"])
    met = spans.join(texts, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_hash")))
    hit = F.substring(F.col("text"), (F.col("start_at") + 1).cast("int"), (F.col("end_at") - F.col("start_at")).cast("int"))
    return met.select("doc_id", "text_hash", "kind", "start_at", "end_at", hit.alias("hit"), "is_base")


def summarise(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of base spans by kind, digest of the base spans, all spans as text."""
    rank = F.lit(0)
    for n, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, n).otherwise(rank)
    named = F.concat_ws(":", "kind", F.col("start_at").cast("string"), F.col("end_at").cast("string"))
    listed = spans.withColumns({"_rank": rank, "_named": named}).groupBy("doc_id", "text_hash").agg(
        *(F.count_if((F.col("kind") == k) & F.col("is_base")).alias(f"n_{k}") for k in BASE),
        F.array_sort(F.collect_list(F.struct("_rank", "start_at", "_named", "is_base"))).alias("_all"))
    joined_text = lambda a: F.array_join(F.transform(a, lambda s: s["_named"]), ",")
    texts = listed.withColumns({"_base": joined_text(F.filter("_all", lambda s: s["is_base"])), "spans": joined_text(F.col("_all"))}).withColumnsRenamed({"doc_id": "_doc_id"})
    keys = docs.select("doc_id", F.xxhash64("text").alias("_hash"), F.col("text").isNull().alias("_none"))
    out = keys.join(texts, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_hash") == F.col("text_hash")) & ~F.col("_none"), "left")
    return out.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce("_base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
