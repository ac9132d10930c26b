"""Main text of web pages by template deduction with equivalence classes.

Pages of one host are read as streams of tags. A token is a tag together with the tags it
lies in. Tokens that occur equally often on every page of the host (they share their occurrence
vector) form an equivalence class; a class is large if enough pages of the host have it.
Classes nest by the tags they lie in, and together they are the host's template: what lies
between two of its tokens is a slot. Slots gather statistics over all pages (text, links, whether
the text varies), and these decide: the holder is the container with most of the text that
varies. Inside it all slots are taken but link lists and headers that say the same on every page. Beside it
slots are taken whose text varies and is not mostly links; if the holder has the host's top
heading, only those with a good share of the host's text.

Names of tags and classes (menus, notices, comments and the like) are a prior on slots: their text
counts less in the search for the holder, and they are left out, but never a tag around most of
the host's text. `words=False` turns the prior off. A page without the host's holder, and any
page of a host without a holder below its body, is decided in the same way by its own text.

Occurrence vectors are compared by their hashes: the sum, over pages, of a hash of page and
count, a grouped aggregation with map-side sums. A host's template has few rows whatever its
number of pages; PRIOR_PAGES pages with the mean counts of all hosts are added to each
host's, so that small hosts lean on all others, and large ones do not.

Defined results: null html counts as empty; an empty page and a page without text in slots
give an empty text; a page cut off in a tag ends before it; a null or broken url is the
host without name; repeated rows give repeated rows, also in the counts; pages that share an id or
have none count as one page seen often; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesearch.llm.bpe import in_slices
from lakesearch.session import written

#: A class must be on this share of the host's pages.
MIN_SHARE = 0.2
#: So many pages with the mean counts of all hosts are added to each host.
PRIOR_PAGES = 3
#: The holder is the innermost container with this share of the text.
CONTAINER_SHARE = 0.6
#: Text in a tag whose name speaks against it counts so much in the search for the holder.
DOUBT = 0.25
#: Beside a holder with the top heading, slots from this share of the host's text on are taken.
BESIDE_SHARE = 0.1
#: Stands for all hosts together.
ALL_HOSTS = "*"

# ---- fixed values: element names and words of class names and ids ----------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg canvas audio video noembed noframes xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr br img".split()
)
HARD = set("head title button select textarea option".split()) | RAW
OUTSIDE = set("nav header footer aside form dialog menu".split())
MAIN = set("article main".split())
OUTSIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget comment comments disqus respond replies reply "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended pagination pager toolbar search skip".split()
)
MAIN_WORDS = set("article content post entry story main body text".split())
CLOSES = {  # an opening tag ends an open one of these, up to the given container
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# -----------------------------------------------------------------------------

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


def _step(name: str, attributes: str) -> str:
    """A tag as the template sees it: name, and the words of class, id and role."""
    words = {w for m in NAMED.finditer(attributes) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower())} if "=" in attributes else ()
    if attributes and HIDDEN.search(attributes):
        words = {*words, "popup"}
    return ".".join([name, *sorted(words)])


class Page:
    """Tokens and blocks of one page. A block is (path, text, characters in links)."""

    def __init__(self, html: str):
        self.tokens: dict[str, int] = defaultdict(int)
        self.blocks: list[tuple[str, str, int]] = []
        self._stack: list[str] = []
        self._paths = [""]
        self._words: list[str] = []
        self._links = self._in_link = 0
        at, n = 0, len(html)
        while at < n:
            m = TAG.search(html, at)
            if m is None:
                self._text(html[at:])
                break
            self._text(html[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name)
                continue
            attributes = m[3] if m[2] else m[6]
            self._open(name, attributes)
            if name in RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else n
                self._close(name)
        self._flush()

    def _text(self, text: str) -> None:
        if text:
            self._words.append(text)
            if self._in_link:
                self._links += len(text)

    def _flush(self) -> None:
        if self._words:
            text = SPACE.sub(" ", unescape("".join(self._words))).strip()
            if text:
                self.blocks.append((self._paths[-1], text, self._links))
            self._words.clear()
        self._links = 0

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self._words.append(" ")
        if name == "a":
            self._in_link = 1
        if name in INLINE:
            return
        self._flush()
        if name in CLOSES:
            names, within = CLOSES[name]
            for i in range(len(self._stack) - 1, -1, -1):
                if self._stack[i] in within:
                    break
                if self._stack[i] in names:
                    self._cut(i)
                    break
        elif "p" in self._stack and name not in VOID:
            self._cut(len(self._stack) - 1 - self._stack[::-1].index("p"))
        path = f"{self._paths[-1]}/{_step(name, attributes)}"
        self.tokens[path] += 1
        if name not in VOID and not attributes.endswith("/"):
            self._stack.append(name)
            self._paths.append(path)

    def _close(self, name: str) -> None:
        if name == "a":
            self._in_link = 0
        if name in INLINE:
            return
        self._flush()
        if name in self._stack:
            self._cut(len(self._stack) - 1 - self._stack[::-1].index(name))

    def _cut(self, depth: int) -> None:
        del self._stack[depth:]
        del self._paths[depth + 1 :]


HEADING = re.compile(r"h[1-6](?=\.|$)")
SMALL = re.compile(r"(?:p|h[1-6]|li|td|pre|blockquote)(?=\.|$)")


@lru_cache(1 << 16)
def _doubtful(step: str, inside: bool = False) -> bool:
    """Whether the name or words of a tag speak against its text; a header may stand inside an article."""
    name, *words = step.split(".")
    named = ({name} & OUTSIDE) | (set() if name in ("html", "body", *MAIN) else OUTSIDE_WORDS.intersection(words))
    return bool(named - {"header"} if inside else named)


@lru_cache(1 << 16)
def hard(path: str) -> bool:
    """Whether a tag of the path never holds text of the page."""
    return any(step.split(".", 1)[0] in HARD for step in path.split("/"))


def within(path: str, holder: str) -> bool:
    return not holder or path == holder or path.startswith(holder + "/")


def vetoed(path: str, holder: str, spine: str) -> bool:
    """Whether a doubtful tag lies around the text that is not around most of the host's text."""
    around = ""
    for step in path.split("/")[1:]:
        inside = holder != "" and within(around, holder)
        around = f"{around}/{step}"
        if not within(spine, around) and _doubtful(step, inside):
            return True
    return False


class Slot(NamedTuple):
    path: str
    chars: float
    links: float
    varies: bool
    weight: float  # of its text: less than one if it is the same on every page


class Rule(NamedTuple):
    """What a host's slots say: holder, deepest tag around half of the text, and the slots to leave or take."""

    holder: str = ""
    spine: str = ""
    closed: bool = False
    dropped: frozenset[str] = frozenset()
    beside: frozenset[str] = frozenset()


def _rank(path: str, words: bool) -> int:
    name, *named = path.rsplit("/", 1)[-1].split(".")
    return 0 if not words else 2 if name in MAIN or "main" in named and name == "div" else 1 if not MAIN_WORDS.isdisjoint(named) else 0


def decide(slots: list[Slot], words: bool = True) -> Rule:
    slots = [s for s in slots if s.chars and not hard(s.path)]
    mass: dict[str, float] = defaultdict(float)
    for s in slots:
        steps = s.path.split("/")
        doubts = sum(_doubtful(step) for step in steps) if words else 0
        own = s.weight * max(0.0, s.chars - 2 * s.links) * DOUBT**doubts
        for i in range(1, len(steps) + 1):
            mass["/".join(steps[:i])] += own
    total = mass.get("", 0.0)
    if total <= 0:
        return Rule()
    fit = [p for p, m in mass.items() if m >= CONTAINER_SHARE * total]
    spine = max((p for p, m in mass.items() if m > total / 2), key=lambda p: p.count("/"))
    # A container named as one first; among equals the innermost that still holds most of the text.
    named = [p for p in fit if _rank(p, words)]
    if named:
        holder = max(named, key=lambda p: (_rank(p, words), -p.count("/"), p))
    else:
        holder = max((p for p in fit if not SMALL.match(p.rsplit("/", 1)[-1])), key=lambda p: (p.count("/"), p), default="")
    open_ = [s for s in slots if not (words and vetoed(s.path, holder, spine))]
    headings = [(m[0], within(s.path, holder)) for s in open_ if s.varies and 2 * s.links <= s.chars and (m := HEADING.match(s.path.rsplit("/", 1)[-1]))]
    closed = bool(headings) and (min(headings)[0], True) in headings
    dropped, beside = set(), set()
    for s in open_:
        listed = 2 * s.links > s.chars
        if within(s.path, holder):
            headed = words and any(_doubtful(step) for step in s.path[len(holder) :].split("/")) and not within(spine, s.path)
            if not s.varies and (listed or headed):
                dropped.add(s.path)
        elif s.varies and not listed and (not closed or mass[s.path] >= BESIDE_SHARE * total):
            beside.add(s.path)
        else:
            dropped.add(s.path)
    return Rule(holder, spine, closed, frozenset(dropped), frozenset(beside))


def slot_of(path: str, template: set[str]) -> str:
    """The innermost token of the template around a block."""
    while path and path not in template:
        path = path.rpartition("/")[0]
    return path


def own_rule(page: Page, words: bool = True) -> Rule:
    """The rule that the page's own text gives: nothing is known of what varies."""
    sums: dict[str, list[int]] = {}
    for path, text, links in page.blocks:
        s = sums.setdefault(path, [0, 0])
        s[0] += len(text)
        s[1] += links
    return decide([Slot(path, chars, links, True, 1.0) for path, (chars, links) in sums.items()], words)


def main_text(page: Page, template: set[str], rule: Rule, words: bool = True) -> str:
    """The blocks of the page's main text, two line ends between them."""
    if rule.holder.count("/") < 3 and rule.holder.rsplit("/", 1)[-1].split(".")[0] in ("", "html", "body") or rule.holder not in page.tokens:
        own = own_rule(page, words)
        # The slots that the host's pages have shown to repeat stay out.
        rule, template = own._replace(dropped=own.dropped | {d for d in rule.dropped if not within(d, own.holder)}), set(page.tokens)

    def kept(path: str, text: str, links: int) -> bool:
        if hard(path) or words and vetoed(path, rule.holder, rule.spine):
            return False
        slot = slot_of(path, template)
        if rule.closed and not within(path, rule.holder):
            return slot in rule.beside
        return slot not in rule.dropped if path == slot or slot in rule.beside else 2 * links <= len(text) or within(path, rule.holder)

    return "\n\n".join(text for path, text, links in page.blocks if kept(path, text, links))


def _token_counts(pages: DataFrame) -> DataFrame:
    """(host, token, pages, vector, chars, links, least, most), summed over each slice of a task's pages.

    `pages` has host, id and html. The empty token stands for the page itself. `least` and `most` are
    the bounds of the hash of a page's text right in the token: they differ if the text varies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for batch in in_slices(whole, 2):
                sums: dict[tuple[str, str], list[int]] = {}
                for host, key, html in zip(*(c.to_pylist() for c in batch.columns)):
                    page = Page(html)
                    mass: dict[str, list[int]] = {}
                    texts: dict[str, list[str]] = defaultdict(list)
                    for path, text, links in page.blocks:
                        m = mass.setdefault(path, [0, 0])
                        m[0] += len(text)
                        m[1] += links
                        texts[path].append(text)
                    for token, n in [("", 1), *page.tokens.items()]:
                        s = sums.setdefault((host, token), [0, 0, 0, 0, None, None])
                        chars, links = mass.get(token, (0, 0))
                        s[0] += 1
                        s[1] = (s[1] + xxhash.xxh64_intdigest(f"{key}|{n}")) % (1 << 64)
                        s[2] += chars
                        s[3] += links
                        if token in texts:
                            h = xxhash.xxh64_intdigest("\n".join(texts[token]).encode("utf-8", "replace")) >> 1
                            s[4], s[5] = (h, h) if s[4] is None else (min(s[4], h), max(s[5], h))
                rows = [(h, t, n, v - (1 << 64) if v >> 63 else v, *rest) for (h, t), (n, v, *rest) in sums.items()]
                columns = list(zip(*rows)) if rows else [[]] * 8
                kinds = (pa.string(), pa.string(), *[pa.int64()] * 6)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "token", "pages", "vector", "chars", "links", "least", "most"])

    return pages.mapInArrow(run, "host string, token string, pages long, vector long, chars long, links long, least long, most long")


def classes(counts: DataFrame) -> DataFrame:
    """(host, token, class, pages, host_pages, chars, links, varies) of the tokens in large classes.

    A class is named by its occurrence vector. Rows of ALL_HOSTS are the sums over hosts; a host's own
    are those that PRIOR_PAGES more pages could make large.
    """

    def sums(vector: str) -> list[Column]:
        return [F.sum("pages").alias("pages"), F.sum(vector).alias("vector"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.min("least").alias("least"), F.max("most").alias("most")]

    # Sums of 64-bit hashes go beyond a long.
    own = written(counts.withColumn("wide", F.col("vector").cast("decimal(20,0)")).groupBy("host", "token").agg(*sums("wide")))
    pooled = own.groupBy("token").agg(*sums("vector")).select(F.lit(ALL_HOSTS).alias("host"), "token", "pages", F.col("vector").cast("string").alias("vector"), "chars", "links", "least", "most")
    rows = own.withColumn("vector", F.col("vector").cast("string")).unionByName(pooled)
    sizes = rows.where("token = ''").select("host", F.col("pages").alias("host_pages"))
    prior = F.when(F.col("host") == ALL_HOSTS, 0).otherwise(PRIOR_PAGES)
    large = rows.where("token <> ''").join(sizes, "host").where(F.col("pages") + prior >= (F.col("host_pages") + prior) * MIN_SHARE)
    return large.select("host", "token", F.col("vector").alias("class"), "pages", "host_pages", "chars", "links", F.coalesce(F.col("least") < F.col("most"), F.lit(False)).alias("varies"))


RULE = "host string, template array<string>, holder string, spine string, closed boolean, dropped array<string>, beside array<string>"


def deduce(pages: DataFrame, words: bool = True) -> DataFrame:
    """One row a host, and ALL_HOSTS: its template and rule (see RULE)."""
    found = written(classes(_token_counts(pages)))
    # Tokens that MIN_SHARE of all pages hold: few, whatever the number of hosts.
    common = {r.token: (r.pages / r.host_pages, r.chars / r.host_pages, r.links / r.host_pages, r.varies) for r in found.where(F.col("host") == ALL_HOSTS).collect()}

    def nest(rows: pd.DataFrame) -> pd.DataFrame:
        host, n = rows["host"].iloc[0], int(rows["host_pages"].iloc[0])
        prior = 0 if host == ALL_HOSTS else PRIOR_PAGES
        none = (0.0, 0.0, 0.0, False)
        large = [p + prior * common.get(t, none)[0] >= MIN_SHARE * (n + prior) for t, p in zip(rows["token"], rows["pages"])]
        rows = rows[large]
        # A class nests in the one around its outermost token; its tokens that lie elsewhere are left out.
        members: dict[str, set[str]] = defaultdict(set)
        of = dict(zip(rows["token"], rows["class"]))
        for token, name in of.items():
            members[name].add(token)

        def around(token: str) -> str | None:
            path = token.rpartition("/")[0]
            while path and (path not in of or of[path] == of[token]):
                path = path.rpartition("/")[0]
            return path or None

        def outer(token: str) -> str | None:
            path = around(token)
            return path and of[path]

        nests = {name: outer(min(tokens, key=lambda t: (t.count("/"), t))) for name, tokens in members.items()}
        template = {t for t, name in of.items() if outer(t) == nests[name]}
        slots: dict[str, list] = {}
        for token, chars, links, varies in zip(rows["token"], rows["chars"], rows["links"], rows["varies"]):
            s = slots.setdefault(slot_of(token, template), [0.0, 0.0, 0.0, False])
            shared = common.get(token, none)
            # One page alone shows nothing of what varies: then all hosts tell, and unknown text may vary.
            changes = bool(varies) or n == 1 and (token not in common or shared[3])
            lent = (prior * shared[1], prior * shared[2])
            s[0] += chars + lent[0]
            s[1] += links + lent[1]
            s[2] += chars * (1.0 if changes else 1.0 / n) + (lent[0] if shared[3] else 0.0)
            s[3] = s[3] or changes
        given = [Slot(path, chars, links, varies, min(1.0, mass / chars) if chars else 0.0) for path, (chars, links, mass, varies) in slots.items()]
        rule = decide(given, words)
        template |= {rule.holder} - {""}
        return pd.DataFrame({"host": [host], "template": [sorted(template)], "holder": [rule.holder], "spine": [rule.spine], "closed": [rule.closed], "dropped": [sorted(rule.dropped)], "beside": [sorted(rule.beside)]})

    # A host has at most the tokens that MIN_SHARE of its pages hold: a small group.
    return found.groupBy("host").applyInPandas(nest, RULE)


def extract(pages: DataFrame, key: str, host: Column, html: str = "html", words: bool = True) -> DataFrame:
    """(key columns, text) of every page; `key` names a column, or several by commas."""
    keys = [k.strip() for k in key.split(",")]
    named = pages.select(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], F.coalesce(F.lower(host), F.lit("")).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    counted = named.select("host", F.coalesce(F.col("key_0").cast("string"), F.lit("")).alias("id"), "html")
    templates = written(deduce(counted, words))
    parts = ["template", "holder", "spine", "closed", "dropped", "beside"]
    joined = named.join(templates.where(F.col("host") != ALL_HOSTS), "host", "left").select(*[f"key_{i}" for i in range(len(keys))], "html", *parts)
    kinds = ", ".join(f"key_{i} {pages.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, n):
                texts = []
                for html, template, holder, spine, closed, dropped, beside in zip(*(batch.column(n + i).to_pylist() for i in range(7))):
                    # A host without any token has no template.
                    rule = Rule() if template is None else Rule(holder, spine, closed, frozenset(dropped), frozenset(beside))
                    texts.append(main_text(Page(html), set(template or ()), rule, words))
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], names=[*[f"key_{i}" for i in range(n)], "text"])

    found = joined.mapInArrow(run, f"{kinds}, text string")
    return found.select(*[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)], "text")
