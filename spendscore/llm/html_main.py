"""Main text of web pages by equivalence classes of tokens.

Tokens are tags, told apart by the containers they are in, and runs of text. Over the distinct pages of a host each
token has an occurrence vector: how often each page has it. Tokens with one vector are a class, found as a
group of equal fingerprints (xor over the pages of two hashes of page and count), so vectors are never built and a host of
any size is a plain aggregate. A class is valid if it is frequent and large, and on every page its tokens stand in one order,
once or several times round; and classes must nest: one lies in the same gap of its neighbour's tokens on all pages, or it is
dropped. The valid classes, nested, are the host's template; what lies between two of its tokens is a slot. Slots are told by the tag before
them, and weighed over the host: those that hold main text are extracted, page by page.

What is main text in a slot is decided by the elements around it (``html_walk``). Hosts differ in what they mark: an article
element, else a main element, else a name like ``content``; where there is none of it, the container with most text that isn't
the same on all pages. Pages whose host has no template, or in which the host's slots are empty, are judged by themselves.
"""

from __future__ import annotations

import html
from collections import Counter

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import removed, shipped, written_at
from spendscore.llm.html_walk import PLAIN, Token, walk

#: A class is frequent if its tokens are on this share of the host's distinct pages, and on so many; large, if it has so many tokens.
SHARE, PAGES, TOKENS = 0.5, 3, 3
#: Text that every page of a host has is part of the template only where there are so many distinct pages.
FIXED_PAGES = 10
#: A host with more than this share of the rows is dealt to this many tasks; there are at most 1/share such hosts.
HOT_SHARE, SALTS = 0.002, 64

SEQUENCE = "host string, page long, tokens array<long>, counts array<int>, order array<long>, at array<int>, chars array<int>, role array<int>, container array<long>"
JUDGED = "host string, class long, size int, perm long, around long, ok boolean"
WEIGHED = "host string, slot long, rank int, container long, chars long"


def _chars(token: Token) -> int:
    """Weight of a text: its signs other than blanks; a link's count little."""
    signs = len("".join(token.text.split()))
    return max(1, signs // 10) if token.link else signs


def _sequences(batches):
    """A page's distinct tokens and their counts, its tokens in order, and weight, role and container of its texts."""
    for pdf in batches:
        rows = []
        for host, page in zip(pdf["host"], pdf["html"]):
            found = list(walk(page))
            texts = [(k, t) for k, t in enumerate(found) if t.text is not None]
            counts = Counter(t.mark for t in found)
            rows.append((
                host, xxhash.xxh64_intdigest(page.encode("utf-8", "surrogatepass")) - (1 << 63), [*counts], [*counts.values()], [t.mark for t in found],
                [k for k, _ in texts], [min(_chars(t), 1 << 30) for _, t in texts], [t.role for _, t in texts], [t.inside[-1] if t.inside else 0 for _, t in texts]))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SEQUENCE.split(", ")])


def _nested(order, classes: dict[int, int], sizes: dict[int, int]):
    """Per class on one page: the order of its tokens, whether it is kept in every round, and the place around it.

    The place is the innermost open round of another class and the gap in it. A round that isn't closed before
    one around it ends crosses it: then the one that began later isn't nested.
    """
    perms: dict[int, list[int]] = {}
    seen: Counter[int] = Counter()
    bad: set[int] = set()
    around: dict[int, tuple[int, int]] = {}
    open_rounds: list[list[int]] = []  # class, tokens of the round so far
    for mark in order:
        own = classes.get(mark)
        if own is None:
            continue
        place = seen[own] % sizes[own]
        if seen[own] < sizes[own]:
            perms.setdefault(own, []).append(mark)
        elif perms[own][place] != mark:
            bad.add(own)
        seen[own] += 1
        if place == 0:
            top = tuple(open_rounds[-1]) if open_rounds else (0, 0)
            if around.setdefault(own, top) != top:
                bad.add(own)
            open_rounds.append([own, 1])
        else:
            while open_rounds and open_rounds[-1][0] != own:
                bad.add(open_rounds.pop()[0])
            if not open_rounds:
                bad.add(own)
                continue
            open_rounds[-1][1] += 1
        if open_rounds[-1][1] == sizes[own]:
            open_rounds.pop()
    bad.update(own for own, _ in open_rounds)
    bad.update(own for own in perms if len(set(perms[own])) < len(perms[own]))
    for own, perm in perms.items():
        yield own, perm, around[own], own not in bad


def _judged(batches):
    for pdf in batches:
        rows = []
        for host, order, marks, classes, class_sizes in zip(pdf["host"], pdf["order"], pdf["marks"], pdf["classes"], pdf["sizes"]):
            of = dict(zip(marks.tolist(), classes.tolist()))
            sizes = dict(zip(classes.tolist(), class_sizes.tolist()))
            for own, perm, around, ok in _nested(order.tolist(), of, sizes):
                rows.append((host, own, sizes[own], _of(perm), _of(around), ok))
        yield pd.DataFrame(rows, columns=["host", "class", "size", "perm", "around", "ok"])


def _of(numbers) -> int:
    return xxhash.xxh64_intdigest(",".join(map(str, numbers))) - (1 << 63)


def _weighed(batches):
    """Text per slot, rank of its region and container, summed within the batch; the template's own has no weight."""
    for pdf in batches:
        total: Counter[tuple] = Counter()
        for host, order, at, chars, role, container, marks in zip(
                pdf["host"], pdf["order"], pdf["at"], pdf["chars"], pdf["role"], pdf["container"], pdf["marks"]):
            template = set(marks.tolist())
            texts = dict(zip(at.tolist(), zip(chars.tolist(), role.tolist(), container.tolist())))
            slot = 0
            for k, mark in enumerate(order.tolist()):
                if k not in texts:
                    slot = mark if mark in template else slot
                elif texts[k][1] >= PLAIN:
                    weight, rank, around = texts[k]
                    total[host, slot, rank, around] += 0 if mark in template else weight
        yield pd.DataFrame([(*key, n) for key, n in total.items()], columns=["host", "slot", "rank", "container", "chars"])


def _joined(tokens: list[tuple[Token, bool]], template: frozenset[int]) -> str:
    """Kept texts as blocks: references decoded, blanks within a block made one, blocks parted by an empty line.

    A block goes if all of it is the template's; where it is beside other text, as a full stop after a word, it stays.
    """
    blocks: list[str] = []
    parts: list[str] = []
    own = False
    for token, kept in [*tokens, (Token(0, None, 0, (), False, 2), False)]:
        if token.text is not None:
            if kept:
                parts.append(html.unescape(token.text))
                own = own or token.mark not in template
        elif token.breaks == 1:
            parts.append(" ")
        elif token.breaks == 2:
            if own:
                blocks.append(" ".join("".join(parts).split()))
            parts, own = [], False
    return "\n\n".join(b for b in blocks if b)


def main_text(page: str, template: frozenset[int], slots: frozenset[int], rank: int, container: int) -> str:
    """The texts of a page in the chosen slots, by the host's rank; by itself where these give none."""
    found = list(walk(page))
    if slots:
        kept, slot = [], 0
        for t in found:
            if t.mark in template and t.text is None:
                slot = t.mark
            kept.append((t, t.text is not None and slot in slots and t.role >= rank and (rank > PLAIN or container in t.inside or not container)))
        text = _joined(kept, template)
        if text:
            return text
    texts = [t for t in found if t.text is not None and t.role >= PLAIN and t.mark not in template]
    rank = max((t.role for t in texts), default=PLAIN)
    inside: Counter[int] = Counter()
    for t in texts:
        inside[t.inside[-1] if t.inside else 0] += _chars(t)
    best = max(inside, key=lambda c: (inside[c], -c), default=0)
    return _joined([(t, t.text is not None and t.role >= rank and (rank > PLAIN or best in t.inside or not best)) for t in found], template)


def _extracted(batches):
    for pdf in batches:
        known: dict[str, tuple] = {}
        text = []
        for host, page, marks, slots, rank, container in zip(
                pdf["host"], pdf["html"], pdf["marks"], pdf["slots"], pdf["rank"], pdf["container"]):
            if marks is None or slots is None:
                text.append(main_text(page, frozenset(), frozenset(), 0, 0))
                continue
            if host not in known:
                known[host] = frozenset(marks.tolist()), frozenset(slots.tolist()), int(rank), int(container[0])
            text.append(main_text(page, *known[host]))
        yield pd.DataFrame({"id": pdf["id"], "url": pdf["url"], "text": text})


def host_of(url: Column) -> Column:
    """The host of an address in lower case; NULL if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _salted(templates: DataFrame, hot: DataFrame) -> DataFrame:
    """A hot host's template as often as its rows are dealt."""
    hot = F.broadcast(hot.withColumn("hot", F.lit(True)))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return templates.join(hot, "host", "left").withColumn("salt", F.explode(salts)).drop("hot")


def _with_template(rows: DataFrame, salted: DataFrame, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` beside their host's template, a written table: Spark sees its size, and only if it is large are rows shuffled.

    Then a hot host's rows go to many tasks.
    """
    hot = F.broadcast(hot.withColumn("hot", F.lit(True)))
    salt = F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int")
    return rows.join(hot, "host", "left").withColumn("salt", salt).drop("hot").join(salted, ["host", "salt"], how).drop("salt")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: ``id_col``, ``url_col``, text, n_chars (code points).

    The text is the page's main text, whole: no length is dropped or cut. References are decoded, blanks in a block become one,
    blocks are in page order, parted by an empty line; line breaks and cells part words. Menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles, hidden elements and reader comments go, as do blocks that are the template's own text, which needs
    a host with ten or more distinct pages.

    * NULL and empty html give an empty text and 0, as do pages without main text. NULL ids and addresses stay as they are;
      a page without a host is judged by itself.
    * Every row gives one row, repeated ids and rows too. Equal pages of a host count once as evidence, so copies don't become a template.
    * Unclosed comments, tags, scripts and elements reach as far as in a browser. Long pages and texts are handled whole, one page at a time.
    * Ties: of containers with equally much text the smallest hash, so the result doesn't depend on order.
    * An empty table gives no rows; extra columns, whatever their names, are not looked at.
    """
    spark = shipped(pages.sparkSession)
    rows = pages.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    ).withColumn("host", host_of(F.col("url")))
    sequences, sequences_at = written_at(
        rows.where(F.col("host").isNotNull() & (F.col("html") != "")).select("host", "html").mapInPandas(_sequences, SEQUENCE)
        .dropDuplicates(["host", "page"]), "page-tokens")
    hosts, hosts_at = written_at(sequences.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    total = rows.count()
    hot, hot_at = written_at(
        rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > total * HOT_SHARE) & F.col("host").isNotNull()).select("host"), "hot-hosts")

    # Occurrence vectors: how many pages, and two fingerprints of (page, count) over them.
    token = sequences.select("host", "page", F.explode(F.arrays_zip("tokens", "counts")).alias("t")).select("host", "page", "t.tokens", "t.counts")
    vectors = token.groupBy("host", F.col("tokens").alias("mark")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("page", "counts")).alias("a"), F.bit_xor(F.xxhash64("counts", "page")).alias("b"))
    frequent = vectors.join(hosts, "host").where((F.col("n") >= PAGES) & (F.col("n") >= SHARE * F.col("pages")))
    # A class has at most as many tokens as one page that they are all on.
    classes, classes_at = written_at(
        frequent.groupBy("host", F.xxhash64("n", "a", "b").alias("class")).agg(F.collect_list("mark").alias("mark"))
        .where(F.size("mark") >= TOKENS), "token-classes")
    proposed, proposed_at = written_at(_salted(
        classes.select("host", "class", F.size("mark").alias("size"), F.explode("mark").alias("mark"))
        .groupBy("host").agg(F.collect_list(F.struct("mark", "class", "size")).alias("t"))
        .select("host", F.col("t.mark").alias("marks"), F.col("t.class").alias("classes"), F.col("t.size").alias("sizes")), hot), "proposed-templates")
    judged = _with_template(sequences.select("host", "order"), proposed, hot).mapInPandas(_judged, JUDGED)
    valid = (
        judged.groupBy("host", "class").agg(
            F.bool_and("ok").alias("ok"), F.min("perm").alias("perm"), F.max("perm").alias("perm2"), F.min("around").alias("around"), F.max("around").alias("around2"))
        .where(F.col("ok") & (F.col("perm") == F.col("perm2")) & (F.col("around") == F.col("around2"))).select("host", "class"))
    # Text is a template's own only if the host has pages enough; tags are in any case.
    text_marks = sequences.select("host", F.explode(F.transform("at", lambda k: F.col("order")[k])).alias("mark")).distinct()
    template, template_at = written_at(_salted(
        classes.join(valid, ["host", "class"]).select("host", F.explode("mark").alias("mark"))
        .join(text_marks.withColumn("is_text", F.lit(True)), ["host", "mark"], "left").join(hosts, "host")
        .where(F.col("is_text").isNull() | (F.col("pages") >= FIXED_PAGES))
        .groupBy("host").agg(F.collect_list("mark").alias("marks")), hot), "templates")

    # What the slots hold decides, over all pages of a host, which are extracted.
    weights, weights_at = written_at(
        _with_template(sequences.select("host", "order", "at", "chars", "role", "container"), template, hot).mapInPandas(_weighed, WEIGHED)
        .groupBy("host", "slot", "rank", "container").agg(F.sum("chars").alias("chars")), "slots")
    ranks = weights.where("chars > 0").groupBy("host").agg(F.max("rank").alias("best"))
    of_rank = weights.join(ranks, "host").where(F.col("rank") == F.col("best"))
    container = of_rank.groupBy("host", "container").agg(F.sum("chars").alias("n")).groupBy("host").agg(
        F.array(F.max_by("container", F.struct("n", -F.col("container")))).alias("container"))
    chosen = of_rank.groupBy("host").agg(F.collect_set("slot").alias("slots"), F.first("best").alias("rank"))
    decided, decided_at = written_at(template.join(chosen, "host").join(container, "host"), "decided-templates")
    result, _ = written_at(
        _with_template(rows.select("id", "url", "html", "host"), decided, hot, "left")
        .mapInPandas(_extracted, "id string, url string, text string")
        .select(F.col("id").cast(pages.schema[id_col].dataType).alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")), "main-texts")
    removed(spark, sequences_at, hosts_at, hot_at, classes_at, proposed_at, template_at, weights_at, decided_at)
    return result
