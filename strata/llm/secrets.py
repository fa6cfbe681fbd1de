"""Secret scans with corpus-wide ownership frequency.

Each text is searched for credential shapes. The value of every candidate is
hashed, and the hashes are aggregated over the whole corpus by distinct owner
and distinct repository: a value that many owners carry is a copied example
(documentation, test fixtures), one that stays with few owners looks live.

The verdict goes by both counts: a value looks live if at most MAX_OWNERS owners
and at most MAX_REPOS (owner, repository) pairs carry it. An owner may well copy
a live secret around, but a value in more repositories than that is an example
that is copied with its surroundings, also within one owner.

Kinds ``assign``, ``access`` and ``hex`` are always reported. Kinds ``vendor``
(provider-specific shapes) and ``mixed`` (long strings mixing cases and digits)
are reported only if they look live and touch no span of the first three.

Offsets are code points, the end exclusive. All work is built-in expressions:
one regex pass tells which texts hold anything, and only those are searched in
detail. Lists of spans are built in parts of ``PART`` matches and joined with
running offsets, overlaps are found by running ends in window functions, and a
redacted text is put together from blocks, so the work grows with a text and
its matches, however long it is. Counting is partially aggregated by (value,
owner, repository) before each shuffle, so one value in a third of all rows
stays one row per task.

Defined results: a null text is empty; a null owner or repository counts as one
owner or repository; repeated rows are judged separately and count once for
ownership if owner and repository repeat too; an empty table gives an empty
result; whole texts are searched, however long; extra columns are kept by
``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_name, let, quoted, stored

#: FIXED VALUES: kinds in their order, each with its pattern, the group that is
#: the secret's value, and the least length of that value.
KINDS = (
    (
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    (
        "vendor",
        r"gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
        0,
        10,
    ),
    ("mixed", r"[A-Za-z0-9+/_-]{24,}", 0, 24),
)
BASE = 3
#: A value carried by more owners than this is a copied example.
MAX_OWNERS = 2
#: So is one in more repositories than this, whoever owns them.
MAX_REPOS = 25
#: Matches of a part of a list, code points of a block of text.
PART, BLOCK = 256, 4096
PLACEHOLDER = "[SECRET]"


def _spans(text: Column, no: int) -> Column:
    """Spans of one kind as array<struct<s, k, e, v>>: leftmost, not
    overlapping. Matches and the gaps between them give the offsets, first
    inside parts of the list, then of the parts."""
    _, pattern, group, least = KINDS[no]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<s:bigint,k:int,e:bigint,v:string>>")

    def walk(parts: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.char_length(F.get(parts["gaps"], i))
            end = start + F.char_length(F.get(parts["whole"], i))
            span = F.struct(start.alias("s"), F.lit(no).alias("k"), end.alias("e"), F.get(parts["value"], i).alias("v"))
            good = F.char_length(F.get(parts["value"], i)) >= least
            if KINDS[no][0] == "mixed":
                for need in (r"[a-z]", r"[A-Z]", r"[0-9][^0-9]*[0-9]"):
                    good = good & F.get(parts["value"], i).rlike(need)
            return F.struct(
                end.alias("at"),
                F.when(good, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"),
            )

        def part(first: Column) -> Column:
            last = F.least(first + (PART - 1), F.size(parts["whole"]) - 1)
            return F.aggregate(F.sequence(first, last), F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("found")), step)

        def moved(pieces: Column) -> Column:
            begins = F.aggregate(pieces, F.array(F.lit(0).cast("bigint")), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + p["at"])))

            def placed(at: Column) -> Column:
                return F.flatten(F.transform(pieces, lambda p, i: F.transform(p["found"], lambda x: F.struct(
                    (x["s"] + F.get(at, i)).alias("s"), x["k"].alias("k"), (x["e"] + F.get(at, i)).alias("e"), x["v"].alias("v")))))

            return let(begins, placed)

        firsts = F.sequence(F.lit(0), F.size(parts["whole"]) - 1, F.lit(PART))
        return let(F.transform(firsts, part), moved)

    parts = F.struct(whole.alias("whole"), value.alias("value"), gaps.alias("gaps"))
    return F.when(text.rlike(pattern), let(parts, walk)).otherwise(empty)


def candidates(text: Column) -> Column:
    """Spans of all kinds by start and kind, those of added kinds that touch a
    base span included. array<struct<s, k, e, h>>, h the value's SHA-256."""

    def of(t: Column) -> Column:
        found = F.concat(*[_spans(t, k) for k in range(len(KINDS))])
        return F.sort_array(F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.sha2(x["v"], 256).alias("h"))))

    return let(F.coalesce(text, F.lit("")), of)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories (each within its owner) of each value
    ``h`` in ``found`` (h, owner, repo)."""
    per_repo = found.groupBy("h", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = per_repo.groupBy("h", "owner").agg(F.count("*").alias("repos"))
    return per_owner.groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def _live(max_owners: int, max_repos: int) -> Column:
    return (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)


def judge(found: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """``found`` (rid, owner, repo, s, k, e, h) with its value's ``n_owners``
    and ``n_repos`` and the verdict ``live``. The join is between plain
    exchanges, so a hot value can be split at run time."""
    counts = stored(ownership(found), "value-owners")
    return found.join(counts, "h").withColumn("live", _live(max_owners, max_repos))


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """Stored scan of every text: rid (a row number of the stored rows), the
    kept columns, owner, repo, and the candidates ``c``."""
    cols = [F.monotonically_increasing_id().alias("rid"), *[quoted(x).alias(f"keep_{i}") for i, x in enumerate(keep)]]
    return stored(
        docs.select(*cols, quoted(owner).alias("owner"), quoted(repo).alias("repo"), candidates(quoted(text)).alias("c")),
        "secrets",
    )


def exploded(scanned: DataFrame) -> DataFrame:
    """(rid, owner, repo, s, k, e, h): one row per span; added kinds that touch
    a base span are left out. A base span that begins before a span touches it
    if the farthest end so far lies inside, one that begins behind it if the
    next start does."""
    rows = scanned.where(F.size("c") > 0).select("rid", "owner", "repo", F.explode("c").alias("x")).select("rid", "owner", "repo", "x.*")
    upto = Window.partitionBy("rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.col("k") < BASE
    reach = F.max(F.when(base, F.col("e"))).over(upto.orderBy("s", "k", "e"))
    ahead = F.min(F.when(base, F.col("s"))).over(upto.orderBy(F.desc("s"), F.desc("k"), F.desc("e")))
    touched = F.coalesce(reach > F.col("s"), F.lit(False)) | F.coalesce(ahead < F.col("e"), F.lit(False))
    return rows.withColumn("touched", touched).where(base | ~F.col("touched")).drop("touched")


def frequencies(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id", max_owners: int = MAX_OWNERS,
                max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per candidate value: its SHA-256 ``h``, the distinct owners and
    (owner, repository) pairs that carry it, and ``live``, the verdict of ``judge``."""
    return ownership(exploded(scan(docs, text, owner, repo))).select("h", "n_owners", "n_repos", _live(max_owners, max_repos).alias("live"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def report(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id", key: str = "doc_id",
           max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of their
    spans, all reported spans, how many look live or are copied, and the most
    owners and repositories that any of its values has."""
    scanned = scan(docs, text, owner, repo, (key,))
    verdicts = judge(exploded(scanned), max_owners, max_repos)
    per_doc = verdicts.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.when((F.col("k") < BASE) | F.col("live"), F.struct("s", "k", "e")))).alias("shown"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_example"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repos").alias("most_repos"),
    )
    base = F.filter("c", lambda x: x["k"] < BASE)
    count = lambda no: F.size(F.filter("c", lambda x: x["k"] == no)).cast("long")
    counts = ("n_live", "n_example", "most_owners", "most_repos")
    return scanned.join(per_doc, "rid", "left").select(
        F.col("keep_0").alias(key),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("shown")), F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
    )


def _rebuilt(text: Column, gaps: Column, last: Column) -> Column:
    """A text from the parts between its secrets and the part after the last,
    cut from blocks, since a text is walked from its start for each cut."""

    def of(blocks: Column) -> Column:
        def piece(a: Column, b: Column) -> Column:
            first, n = F.floor(a / BLOCK), F.floor((b - 1) / BLOCK) - F.floor(a / BLOCK) + 1
            near = F.array_join(F.slice(blocks, (first + 1).cast("int"), n.cast("int")), "")
            return F.when(b > a, F.substring(near, (a - first * BLOCK + 1).cast("int"), (b - a).cast("int"))).otherwise("")

        tail = piece(last, F.char_length(text).cast("bigint"))
        return F.array_join(F.concat(F.transform(gaps, lambda g: piece(g["a"], g["b"])), F.array(tail)), PLACEHOLDER)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), of)


def redact(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id",
           max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """``docs`` with every live-looking span replaced by a placeholder; copied
    examples stay. Each text is searched once: the rows are stored with their
    candidates, those without any pass through, the others are joined with
    their live spans. ``n_chars`` follows the new text."""
    c, rid, gaps, last = (free_name(docs, x) for x in ("found", "rid", "gaps", "last"))
    marked = stored(docs.withColumns({c: candidates(quoted(text)), rid: F.monotonically_increasing_id()}), "searched")
    some = marked.where(F.size(c) > 0)
    found = exploded(some.select(F.col(rid).alias("rid"), quoted(owner).alias("owner"), quoted(repo).alias("repo"), F.col(c).alias("c")))
    before = Window.partitionBy("rid").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    live = judge(found, max_owners, max_repos).where("live").withColumn("a", F.coalesce(F.max("e").over(before), F.lit(0).cast("bigint")))
    spans = live.groupBy(F.col("rid").alias(rid)).agg(
        F.sort_array(F.collect_list(F.when(F.col("s") >= F.col("a"), F.struct("a", F.col("s").alias("b"))))).alias(gaps), F.max("e").alias(last)
    )
    joined = some.join(spans, rid, "left")
    new = F.when(F.col(gaps).isNull(), quoted(text)).otherwise(_rebuilt(quoted(text), F.col(gaps), F.col(last)))
    cleaned = joined.withColumn(text, new)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn(
            "n_chars", F.when(F.col(gaps).isNull(), F.col("n_chars")).otherwise(F.char_length(quoted(text)).cast(docs.schema["n_chars"].dataType))
        )
    rest = marked.where(F.size(c) == 0)
    cols = [quoted(x) for x in docs.columns]
    return rest.select(*cols).unionAll(cleaned.select(*cols))
