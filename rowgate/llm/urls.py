"""URL filter: character language models of accepted and rejected URLs, with host and path rules before them.

Everything is written with DataFrame functions. The rules label the URLs that they decide; these are what the two
models learn from, and the models judge the rest.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.storage import cut

#: Characters of the longest context. Shorter contexts take over where a longer one was rarely or never seen.
CONTEXT = 5
START, END = "\u0002", "\u0003"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the beginning of a path on them."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule("net", "/", False),
    Rule("example.net", "/en/", True),
    Rule("example.com", "/de/", False),
    Rule("org", "/fr/", True),
)


def parts(url: Column) -> dict[str, Column]:
    """``host`` (A-Z lower-cased), ``path``, and ``tail``: all that follows the host. Empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(after, "^[^/?#]*", 0)
    tail = F.substring(after, F.length(raw) + 1, F.length(after))
    return {
        "host": F.translate(raw, string.ascii_uppercase, string.ascii_lowercase),
        "path": F.regexp_extract(tail, "^[^?#]*", 0),
        "tail": tail,
    }


def _ruled(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits (of two of one length the first given), and whether it allows; null if none fits."""
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: len(r.text), reverse=True)[::-1]:
        name = F.when(rule.fits(host, path), F.lit(rule.text)).otherwise(name)
        allow = F.when(rule.fits(host, path), F.lit(rule.allow)).otherwise(allow)
    return name, allow


def _grams(pieces: DataFrame, *keep: str) -> DataFrame:
    """One row for each character of a piece after its context: the context and the character."""
    at = F.sequence(F.lit(1), F.length("piece") - CONTEXT)
    grams = F.transform(at, lambda i: F.substring(F.col("piece"), i, F.lit(CONTEXT + 1)))
    return pieces.where(F.length("piece") > CONTEXT).select(*keep, F.explode(grams).alias("gram"))


def ratios(counts: DataFrame) -> DataFrame:
    """(gram, ratio): log-likelihood of a gram's last character after the others, accepted less rejected.

    ``counts`` has (gram, yes, no) for grams of ``CONTEXT + 1`` characters. Each order is interpolated with the one
    below, by the number of distinct characters seen after its context; the lowest with a uniform choice among all
    characters. Contexts that a class has not seen pass the order below on as it is. A context has at most one row for
    each character, so no join here has a group larger than the alphabet.
    """
    level, levels = counts, [counts]
    for order in range(CONTEXT - 1, -1, -1):
        shorter = F.substring(F.col("gram"), F.lit(2), F.lit(order + 1)).alias("gram")
        level = cut(level.groupBy(shorter).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
        levels.append(level)
    uniform = 1.0 / max(1, level.count())
    # Tables of grams grow with the corpus and take many times their files' bytes in memory, so none is broadcast.
    below = None
    for order, level in enumerate(reversed(levels)):
        level = level.withColumn("context", F.substring("gram", 1, order))
        seen = level.groupBy("context").agg(
            *[F.sum(c).alias(f"all_{c}") for c in ("yes", "no")],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in ("yes", "no")],
        )
        rows = level.join(seen.hint("merge"), "context")
        if below is None:
            rows = rows.withColumns({"below_yes": F.lit(uniform), "below_no": F.lit(uniform)})
        else:
            rows = rows.withColumn("shorter", F.substring("gram", 2, order)).join(below.hint("merge"), "shorter")
        made = {}
        for c in ("yes", "no"):
            total = F.col(f"all_{c}") + F.col(f"kinds_{c}")
            mixed = (F.col(c) + F.col(f"kinds_{c}") * F.col(f"below_{c}")) / total
            made[c] = F.when(total > 0, mixed).otherwise(F.col(f"below_{c}"))
        if order == CONTEXT:
            return rows.select("gram", (F.log(made["yes"]) - F.log(made["no"])).alias("ratio"))
        below = cut(rows.select(F.col("gram").alias("shorter"), *[made[c].alias(f"below_{c}") for c in ("yes", "no")]))


def curve(scores: DataFrame) -> tuple[float, float]:
    """Slope and offset that turn a score into the log-odds of acceptance, from held-out (score, allow).

    The two classes are taken as normal with one variance. Where that cannot be had, for want of a class or of any
    spread, or where accepted URLs do not score higher, the score itself is the log-odds.
    """
    x = F.col("score")
    row = scores.agg(
        *[F.count(F.when(F.col("allow") == v, 1)).alias(f"n_{v}") for v in (True, False)],
        *[F.avg(F.when(F.col("allow") == v, x)).alias(f"m_{v}") for v in (True, False)],
        *[F.coalesce(F.var_pop(F.when(F.col("allow") == v, x)), F.lit(0.0)).alias(f"v_{v}") for v in (True, False)],
    )
    row = row.select(
        *row.columns,
        F.try_divide(F.col("n_True") * F.col("v_True") + F.col("n_False") * F.col("v_False"), F.col("n_True") + F.col("n_False")).alias("v"),
        F.log(F.try_divide("n_True", "n_False")).alias("prior"),
    ).first()
    if not row.n_True or not row.n_False or not row.v or row.m_True <= row.m_False:
        return 1.0, 0.0
    slope = (row.m_True - row.m_False) / row.v
    return slope, row.prior - slope * (row.m_True + row.m_False) / 2


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score) of each row.

    ``verdict`` is that of the longest rule that fits, else ``allow`` where the calibrated ``score``, the probability
    of acceptance, is at least a half. ``rule`` is null where none fits. The models read the host in lower case and
    all that follows it. Three sixteenths of the ruled URLs, by digest, are kept out of the counts and calibrate the
    score. Null and unreadable URLs are judged as the empty text. Repeated rows count as often as they occur and each
    gets its row; other columns are not read. Without any rows the result is empty.

    Hosts and what follows them are counted as distinct pieces first, so that a host with a third of all rows is one
    row from there on. A piece begins with the characters before it, and gives the same grams as in its URL.
    """
    found = parts(F.col(url))
    urls = pages.select(F.col(key).alias("key"), *[c.alias(n) for n, c in found.items()])
    name, allow = _ruled(rules, F.col("host"), F.col("path"))
    head = F.concat(F.lit(START * CONTEXT), F.col("host"))
    urls = urls.withColumns({"rule": name, "allow": allow, "head": head})
    urls = urls.withColumn("rest", F.concat(F.right("head", F.lit(CONTEXT)), "tail", F.lit(END)))
    held_out = F.substring(F.md5(F.concat("host", "tail").cast("binary")), 1, 1) < "3"
    learn = urls.select(
        F.explode(F.array("head", "rest")).alias("piece"),
        *[F.coalesce((F.col("allow") == v) & ~held_out, F.lit(False)).cast("long").alias(c) for c, v in (("yes", True), ("no", False))],
    )
    pieces = learn.groupBy("piece").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    pieces = cut(pieces.withColumn("id", F.monotonically_increasing_id()))
    counts = cut(_grams(pieces, "yes", "no").groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
    ratio = cut(ratios(counts))
    # Spark takes the grams for as small as the pieces they come from, and would broadcast them.
    sums = _grams(pieces, "id").join(ratio.hint("merge"), "gram").groupBy("id").agg(F.sum("ratio").alias("sum"))
    sums = cut(pieces.select("id", "piece").join(sums, "id", "left").select("piece", F.coalesce("sum", F.lit(0.0)).alias("sum")))
    for piece in ("head", "rest"):
        urls = urls.join(sums.select(F.col("piece").alias(piece), F.col("sum").alias(f"sum_{piece}")), piece)
    scored = cut(
        urls.select(
            F.col("key").alias(key),
            "host",
            "path",
            "rule",
            "allow",
            held_out.alias("held_out"),
            ((F.col("sum_head") + F.col("sum_rest")) / (F.length("host") + F.length("tail") + 1)).alias("score"),
        )
    )
    slope, offset = curve(scored.where("held_out and allow is not null"))
    sure = 1 / (1 + F.exp(-(F.col("score") * slope + offset)))
    verdict = F.when(F.coalesce("allow", sure >= 0.5), "allow").otherwise("block")
    return scored.select(key, "host", "path", "rule", verdict.alias("verdict"), sure.alias("score"))
