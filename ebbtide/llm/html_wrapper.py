"""Main text of pages by wrappers that are inferred per host.

Pages of a host are token streams of tags and text slots. A stream is first folded on
itself: neighbours of the same kind become one repeated group. The streams of a host
are then aligned pairwise and iteratively: what both have is kept, a mismatch becomes
optional, equal neighbours that arise become repeated. The result is a union-free
regular expression, held as nested groups. Distinct streams are few, so whole hosts
are aligned, in rounds of bounded size. Each page is then matched against its host's
wrapper, which gives every text a slot by position, not by tags alone. A text that all
pages with a slot have in it is the template's. An article that a
page names by a tag is its text; a page without one, of any template of its host, gives
all slots that are neither template text nor marked as something else.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import q, small_batches

# Distinct streams that one task aligns at a time.
ALIGN = 64
# Pages of a host on which a text must be the same to be part of the template.
TEMPLATE_PAGES = 3
# Part of a host's text that its marks must not drop.
MASS = 0.6

# HTML element names by their role, and words of class, id or role attributes that mark what is not the article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = frozenset("head title nav footer aside form select option menu dialog button label legend fieldset".split())
# Elements whose content is no markup, read to their end tag or the end of the page; those that are left out with what they hold, if they are closed.
RAW = "script|style|template|textarea"
CLOSED = frozenset("noscript iframe object svg canvas audio video button".split())
ARTICLES = ("article", "main")
MARKED = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu "
    "modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply respond share sharing sidebar site-header "
    "site-footer social sponsor sponsored subscribe toolbar widget complementary contentinfo search alert".split()
)
# Words that with marked ones form a compound that is marked too, such as main-nav, comment-list or cookie-bar.
BESIDE = frozenset(
    "area bar block bottom box button buttons container div footer form global head header icons inner item items left link links list main mobile outer "
    "post posts primary right row secondary section site top wrap wrapper".split()
)
# Elements that no attribute marks: layout and topic words in their classes say nothing of their text.
UNMARKED = frozenset("html body main".split())
# Words that mark an article element, which blogs use for single comments too.
MARKED_ARTICLE = frozenset("comment reply".split())
# Blocks whose end tag may be missing.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option html head body hr".split())
# An element of the first kind ends an open element of the second.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def marked(tag: str, token: str) -> bool:
    """Whether a class, id or role token marks an element as no part of the article: it is such a word, or a listed compound with one."""
    if tag in ARTICLES:
        return token in MARKED_ARTICLE and tag not in UNMARKED
    if token in MARKED:
        return tag not in UNMARKED
    pieces = [w for w in re.split(r"[-_]+", token) if w]
    return tag not in UNMARKED and any(w in MARKED for w in pieces) and all(w in MARKED or w in BESIDE for w in pieces)


def key_of(tag: str, attrs: str) -> str:
    """Tag name, with ``!`` if its attributes mark it as no part of the article, with ``*`` if as the article."""
    for name, *values in ATTRIBUTE.findall(attrs) if attrs else ():
        value = "".join(values).lower()
        if name.lower() == "itemprop":
            if value == "articlebody":
                return tag + "*"
        elif name.lower() == "role" and value == "main":
            return tag + "*"
        elif any(marked(tag, token) for token in value.split()):
            return tag + "!"
    return tag


def closed_elements(tokens: list[re.Match]) -> dict[int, int]:
    """Number of the start tag of each closed element of ``CLOSED``, and where its end tag ends.

    An element that is not closed before a block around it ends is none: its tag is passed over and what follows stays.
    """
    past: dict[int, int] = {}
    # Open elements and blocks; the blocks tell where an element can no longer be closed.
    opened: list[tuple[str, int]] = []
    n_open: Counter = Counter()
    for k, m in enumerate(tokens):
        tag = (m["tag"] or "").lower()
        if tag not in CLOSED and (tag not in BLOCKS or tag in VOID or tag in LOOSE):
            continue
        if not m["end"]:
            if not m["attrs"].endswith("/") or tag != "svg":
                opened.append((tag, k))
                n_open[tag] += 1
            continue
        # What is still open inside is not closed by this end tag.
        while n_open[tag]:
            name, start = opened.pop()
            n_open[name] -= 1
            if name == tag:
                if tag in CLOSED:
                    past[start] = m.end()
                break
    return past


def events(page: str | None) -> Iterator[tuple[str, str]]:
    """Tokens of a page: ("<", key), (">", key) for blocks, ("t", text) for the text of one block, whitespace folded."""
    stack: list[tuple[str, str]] = []
    held: list[str] = []

    def text():
        joined = " ".join(html.unescape("".join(held)).split())
        held.clear()
        return joined

    def close(upto: int):
        while len(stack) > upto:
            yield ">", stack.pop()[1]

    at, page = 0, page or ""
    tokens = list(TOKEN.finditer(page))
    past = closed_elements(tokens)
    for k, m in enumerate(tokens):
        if m.start() < at:
            continue
        held.append(page[at : m.start()])
        at = past.get(k, m.end())
        if m["tag"] is None or k in past:
            continue
        tag = m["tag"].lower()
        if tag == "br":
            held.append(" ")
        if tag not in BLOCKS:
            continue
        found = text()
        if found:
            yield "t", found
        if m["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    yield from close(depth)
                    break
            continue
        if stack and stack[-1][0] == "p":
            yield from close(len(stack) - 1)
        if stack and stack[-1][0] in ENDS.get(tag, ()):
            yield from close(len(stack) - 1)
        if tag == "tr" and stack and stack[-1][0] == "tr":
            yield from close(len(stack) - 1)
        key = key_of(tag, m["attrs"])
        yield "<", key
        if tag in VOID or m["attrs"].endswith("/") and tag == "hr":
            yield ">", key
        else:
            stack.append((tag, key))
    held.append(page[at:])
    found = text()
    if found:
        yield "t", found
    yield from close(0)


# A wrapper item is [kind, quantifier, items]: kind is a key or "#" for a text slot;
# the quantifier is "1", "?" (optional), "+" (repeated) or "*" (both).
SLOT = "#"


def _weaken(a: str, b: str) -> str:
    many, none = "+*", "?*"
    repeated, optional = a in many or b in many, a in none or b in none
    return {(False, False): "1", (False, True): "?", (True, False): "+", (True, True): "*"}[repeated, optional]


def unrolled(call):
    """Value of a generator that yields further calls of its kind in place of calling itself: depth costs heap, not stack."""
    waiting, value = [call], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(value))
            value = None
        except StopIteration as done:
            waiting.pop()
            value = done.value
    return value


def fold(items: list) -> list:
    """Neighbours of the same kind as one repeated item."""
    return unrolled(_fold(items))


def align(a: list, b: list) -> list:
    """Least wrapper of this form that both sequences match; pages may be nested to any depth."""
    return unrolled(_align(a, b))


def _plain(a: list, b: list) -> bool:
    """Whether two sequences are equal and hold nothing inside."""
    return len(a) == len(b) and all(not x[2] and not y[2] and x[0] == y[0] and x[1] == y[1] for x, y in zip(a, b))


def _fold(items: list):
    out: list = []
    for kind, times, inner in items:
        if out and out[-1][0] == kind:
            last = out[-1]
            # Present if either is: optional only where both are.
            optional = last[1] in "?*" and times in "?*"
            merged = last[2] if _plain(last[2], inner) else (yield _align(last[2], inner))
            out[-1] = [kind, "*" if optional else "+", merged]
        else:
            out.append([kind, times, inner])
    return out


def _align(a: list, b: list):
    n, m = len(a), len(b)
    # A common beginning is aligned as it is; only what follows needs the table.
    same = next((k for k, (x, y) in enumerate(zip(a, b)) if x[0] != y[0]), min(n, m))
    best = [[0] * (m + 1) for _ in range(n + 1)] if same < n and same < m else []
    for i in range(n - 1, same - 1, -1) if best else ():
        for j in range(m - 1, same - 1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            inner = a[i][2] if _plain(a[i][2], b[j][2]) else (yield _align(a[i][2], b[j][2]))
            out.append([a[i][0], _weaken(a[i][1], b[j][1]), inner])
            i, j = i + 1, j + 1
        elif j >= m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], _weaken(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            out.append([b[j][0], _weaken(b[j][1], "?"), b[j][2]])
            j += 1
    return (yield _fold(out))


def stream(tokens: list[tuple[str, str]]) -> list:
    """Wrapper of a single page."""
    stack: list[list] = [[]]
    keys: list[str] = []
    for kind, value in tokens:
        if kind == "<":
            stack.append([])
            keys.append(value)
        elif kind == ">":
            inner = fold(stack.pop())
            stack[-1].append([keys.pop(), "1", inner])
        else:
            stack[-1].append([SLOT, "1", []])
    return fold(stack[0])


def matched(runs: list[str], items: list) -> list[int]:
    """Item of the wrapper that each run of a page takes, in order; -1 for a run that has none.

    As many runs as possible have an item, and of such ways one that leaves out the fewest
    items that are not optional.
    """
    n, m = len(runs), len(items)
    if n == m and all(r == i[0] for r, i in zip(runs, items)):
        return list(range(n))
    best = [[(0, 0)] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        for j in range(m - 1, -1, -1):
            taken, missed = best[i][j + 1]
            top = (taken, missed - (items[j][1] in "1+"))
            if i < n:
                top = max(top, best[i + 1][j])
                if runs[i] == items[j][0]:
                    taken, missed = best[i + 1][j + 1]
                    top = max(top, (taken + 1, missed))
            best[i][j] = top
    out, i, j = [], 0, 0
    while i < n:
        if j < m and runs[i] == items[j][0] and best[i][j] == (best[i + 1][j + 1][0] + 1, best[i + 1][j + 1][1]):
            out.append(j)
            i, j = i + 1, j + 1
        elif j < m and best[i][j] == (best[i][j + 1][0], best[i][j + 1][1] - (items[j][1] in "1+")):
            j += 1
        else:
            out.append(-1)
            i += 1
    return out


def placed(kinds: list[str], wrapper: list) -> list[str]:
    """Slot of each text of a page, in order: the items of the wrapper on the way to it, with their kinds.

    ``kinds`` has ``<key`` where a group begins, ``>`` where it ends and ``#`` for a text.
    A repeated group's members share their slots. What does not match is placed by its kinds alone.
    """
    root: list = []
    stack, n = [root], 0
    for kind in kinds:
        if kind == SLOT:
            stack[-1].append((SLOT, n))
            n += 1
        elif kind == ">":
            stack.pop()
        else:
            stack[-1].append((kind[1:], []))
            stack.append(stack[-1][-1][1])
    out = [""] * n
    todo = [(root, wrapper, "")]
    while todo:
        children, items, at = todo.pop()
        runs: list[tuple[str, list]] = []
        for kind, inner in children:
            if runs and runs[-1][0] == kind:
                runs[-1][1].append(inner)
            else:
                runs.append((kind, [inner]))
        for (kind, members), j in zip(runs, matched([r[0] for r in runs], items)):
            here = f"{at}/{j}:{kind}"
            for inner in members:
                if kind == SLOT:
                    out[inner] = here
                elif inner:
                    todo.append((inner, items[j][2] if j >= 0 else [], here))
    return out


def path_of(slot: str) -> tuple[str, ...]:
    return tuple(step.split(":", 1)[1] for step in slot.split("/")[1:-1])


def outside(path: tuple[str, ...], void: frozenset = frozenset()) -> bool:
    """Whether a group on the path is never part of the article; marks of the paths in ``void`` do not count.

    A form around a named article is layout.
    """
    inside = False
    named = max((k for k, key in enumerate(path) if key.endswith("*") or key in ARTICLES), default=-1)
    for k, key in enumerate(path):
        name = key.rstrip("!*")
        excluded = name in NOT_TEXT and (name != "form" or k > named)
        if name == "form" and excluded or key.endswith("!"):
            excluded = path[: k + 1] not in void or excluded and name != "form"
        if excluded or name == "header" and not inside:
            return True
        inside = inside or name in ARTICLES
    return False


def void_marks(mass: dict[tuple[str, ...], int]) -> frozenset:
    """Paths of marked groups and forms that would drop most of the host's text, where no article tag outside them has text.

    ``mass`` has the characters of each slot path. Text that its tags exclude does not count.
    """
    void: set[tuple[str, ...]] = set()
    bare = {p: tuple("div" if k.rstrip("!") == "form" else k.rstrip("!") for k in p) for p in mass}
    weight = {p: n for p, n in mass.items() if not outside(bare[p])}
    if any(n and not outside(p) and any(k.endswith("*") or k in ARTICLES for k in p) for p, n in weight.items()):
        return frozenset()
    total = sum(weight.values())
    prefixes: dict[tuple[str, ...], int] = {}
    for p, n in weight.items():
        for k, key in enumerate(p):
            if key.endswith("!") or key == "form":
                prefixes[p[: k + 1]] = prefixes.get(p[: k + 1], 0) + n
    for prefix in sorted(prefixes, key=len):
        if prefixes[prefix] >= MASS * total:
            void.add(prefix)
    return frozenset(void)


def article_slots(paths: list[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Those of a page's open slots that an article tag names: where both are used, the article inside the main part."""
    named: dict[tuple[str, ...], tuple[tuple[str, ...], bool]] = {}
    for p in paths:
        marks = [k for k, key in enumerate(p) if key.endswith("*") or key.rstrip("*!") in ARTICLES]
        if marks:
            inner = p[marks[0]].rstrip("*!") != "article" and any(key.rstrip("*!") == "article" for key in p[marks[0] + 1 :])
            named[p] = (p[: marks[0] + 1], inner)
    deeper = {root for root, inner in named.values() if inner}
    return {p for p, (root, inner) in named.items() if inner or root not in deeper}


def blocks(page: str | None) -> Iterator[tuple[tuple[str, ...], str]]:
    yield from _texts(events(page))


def _texts(tokens) -> Iterator[tuple[tuple[str, ...], str]]:
    path: list[str] = []
    for kind, value in tokens:
        if kind == "<":
            path.append(value)
        elif kind == ">":
            path.pop()
        else:
            yield tuple(path), value


def skeleton(tokens: list[tuple[str, str]]) -> list[str]:
    return [SLOT if kind == "t" else ">" if kind == ">" else "<" + value for kind, value in tokens]


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def written(wrapper: list) -> str:
    """A wrapper as one line per token: quantifier and kind of an item, ``>`` after its inner items."""
    lines: list[str] = []
    todo = [iter(wrapper)]
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
            if todo:
                lines.append(">")
            continue
        lines.append(item[1] + item[0])
        todo.append(iter(item[2]))
    return "\n".join(lines)


@functools.lru_cache(maxsize=256)
def _read_wrapper(text: str) -> list:
    stack: list[list] = [[]]
    for line in text.split("\n") if text else ():
        if line == ">":
            stack.pop()
        else:
            stack[-1].append([line[1:], line[0], []])
            stack.append(stack[-1][-1][2])
    return stack[0]


def main_text(page: str | None, wrapper: str | None, fixed: frozenset, void: frozenset = frozenset()) -> str:
    """Texts of the page's named articles; of a page without such, all that is neither template text nor marked as other.

    ``fixed`` has the (slot, digest) of template texts.
    """
    tokens = list(events(page))
    texts = list(_texts(tokens))
    opened = [not outside(p, void) for p, _ in texts]
    named = article_slots([p for (p, _), o in zip(texts, opened) if o])
    if named:
        chosen = [t for (p, t), o in zip(texts, opened) if o and p in named]
    elif fixed:
        places = placed(skeleton(tokens), _read_wrapper(wrapper))
        chosen = [t for (_, t), o, slot in zip(texts, opened, places) if o and (slot, digest(t)) not in fixed]
    else:
        chosen = [t for (_, t), o in zip(texts, opened) if o]
    return "\n".join(chosen)


def _host(url_col: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(q(url_col)), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _pages_as_streams(pages: DataFrame) -> DataFrame:
    """(host, page, wrapper, kinds, texts): of each page a digest, its own wrapper, its tokens, and characters and digest of its texts."""

    def read(batches):
        for batch in batches:
            found, wrappers, kinds, texts = [], [], [], []
            for page in batch.column("html").to_pylist():
                tokens = list(events(page))
                found.append(digest(page or ""))
                wrappers.append(written(stream(tokens)))
                kinds.append("\n".join(skeleton(tokens)))
                texts.append([{"chars": len(t), "digest": digest(t)} for k, t in tokens if k == "t"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(found, pa.int64()), pa.array(wrappers, pa.string()), pa.array(kinds, pa.string()),
                 pa.array(texts, pa.list_(pa.struct([("chars", pa.int64()), ("digest", pa.int64())])))],
                ["host", "page", "wrapper", "kinds", "texts"],
            )

    form = "host string, page long, wrapper string, kinds string, texts array<struct<chars: long, digest: long>>"
    return pages.select("host", "html").mapInArrow(read, form)


def _slot_statistics(streams: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, slot, digest, pages, chars): of each text in a slot the pages that have it there, with a null digest of all texts.

    Each page is matched against its host's wrapper. Exact copies of a page count once.
    """

    def match(batches):
        for batch in batches:
            host, slot, text, chars = [], [], [], []
            for name, kinds, texts, wrapper in zip(*(batch.column(c).to_pylist() for c in ("host", "kinds", "texts", "wrapper"))):
                sums: dict[str, int] = {}
                held: set[tuple[str, int]] = set()
                for place, t in zip(placed(kinds.split("\n") if kinds else [], _read_wrapper(wrapper)), texts):
                    sums[place] = sums.get(place, 0) + t["chars"]
                    held.add((place, t["digest"]))
                for place, found, size in [*((p, None, n) for p, n in sums.items()), *((p, d, 0) for p, d in held)]:
                    host.append(name)
                    slot.append(place)
                    text.append(found)
                    chars.append(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(slot, pa.string()), pa.array(text, pa.int64()), pa.array(chars, pa.int64())],
                ["host", "slot", "digest", "chars"],
            )

    once = streams.select("host", "page", "kinds", "texts").dropDuplicates(["host", "page"])
    rows = once.join(wrappers, "host").select("host", "kinds", "texts", "wrapper").mapInArrow(match, "host string, slot string, digest long, chars long")
    return rows.groupBy("host", "slot", "digest").agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"))


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper, fixed, void) from (host, html), over all pages of each host.

    ``fixed`` has the template texts as slot and digest: those that all pages with the slot have in it.
    """
    streams = stage(_pages_as_streams(pages), "streams")
    wrappers = streams.select("host", "wrapper").distinct()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        merged = None
        for text in sorted(frame["wrapper"]):
            read = _read_wrapper.__wrapped__
            merged = read(text) if merged is None else align(merged, read(text))
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [written(merged)]})

    while True:
        wrappers = stage(wrappers, "wrappers")
        counts = wrappers.groupBy("host").agg(F.count("*").alias("n"))
        if counts.where(F.col("n") > 1).isEmpty():
            break
        parts = F.ceil(F.col("n") / ALIGN).cast("int")
        dealt = wrappers.join(counts, "host").withColumn("part", F.pmod(F.xxhash64("wrapper"), parts))
        wrappers = dealt.select("host", "wrapper", "part").groupBy("host", "part").applyInPandas(merge, "host string, wrapper string").distinct()

    known = stage(_slot_statistics(streams, wrappers).where(F.col("digest").isNull() | (F.col("pages") >= TEMPLATE_PAGES)), "slots")
    masses = known.where(F.col("digest").isNull()).select("host", "slot", F.col("pages").alias("of"), "chars")
    listed = masses.groupBy("host").agg(F.collect_list(F.struct("slot", "chars")).alias("slots"))
    template = known.where(F.col("digest").isNotNull()).join(masses, ["host", "slot"]).where(F.col("pages") == F.col("of"))
    template = template.groupBy("host").agg(F.collect_list(F.struct("slot", "digest")).alias("fixed"))

    def decide(batches):
        for batch in batches:
            voids = []
            for found in batch.column("slots").to_pylist():
                mass: dict[tuple[str, ...], int] = {}
                for s in found or ():
                    path = path_of(s["slot"])
                    mass[path] = mass.get(path, 0) + s["chars"]
                voids.append(["/".join(p) for p in sorted(void_marks(mass))])
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(voids, pa.list_(pa.string()))], ["host", "void"])

    void = listed.mapInArrow(decide, "host string, void array<string>")
    return stage(wrappers.join(template, "host", "left").join(void, "host", "left"), "decided")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Blocks of the article are joined by a line feed, in page order. A null or empty page
    has the empty text; pages without url, or with one that names no host, share one
    wrapper. A page without a named article gives all text that no tag or attribute marks as
    something else and that is no template text of its host. Rows that repeat an id are
    pages of their own; pages may be nested to any depth. Other columns are not read; an empty input
    gives no rows.
    """
    spark = pages.sparkSession
    small_batches(spark, 500)
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(F.col(q(id_col)).alias("page_id"), F.col(q(url_col)).alias("url"), F.col(q(html_col)).alias("html"), _host(url_col).alias("host"))
    wrappers = infer(rows.select("host", "html"))

    def read(batches):
        for batch in batches:
            texts = []
            for page, wrapper, fixed, void in zip(*(batch.column(c).to_pylist() for c in ("html", "wrapper", "fixed", "void"))):
                template = frozenset((f["slot"], f["digest"]) for f in fixed or ())
                texts.append(main_text(page, wrapper, template, frozenset(tuple(p.split("/")) for p in void or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    # Only hosts with template text match their pages again.
    needed = F.when(F.col("fixed").isNotNull(), F.col("wrapper")).alias("wrapper")
    joined = rows.join(wrappers.select("host", needed, "fixed", "void"), "host", "left")
    return joined.mapInArrow(read, f"page_id {id_type}, url {url_type}, text string, n_chars long")
