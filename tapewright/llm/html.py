"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by stop-word density, length and link
density, menus and other lists of links included; the second lets each undecided block, mostly a short one, take the
label of its nearest decided neighbour. What figures can't tell from an article, as it is prose too, is dropped by tags,
roles and class names: footers, notices, adverts, sidebars, teasers, comments.
"""

import html as entities
import re

from pyspark.sql import functions as F

from tapewright.llm.stopwords import STOP_WORDS

# Names of the markup standard, and class words in common use.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = "script|style|template|noscript|iframe|textarea|select|object|canvas|noembed|noframes|xmp|title"
# Drawings, and what formulas hold beside their text; and the tags at which a drawing ends that was never closed.
FOREIGN_TAGS = frozenset("svg annotation annotation-xml".split())
BREAKOUT_TAGS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strike strong sub sup table tt u ul var".split()
)
INTEGRATION_TAGS = frozenset("foreignobject desc".split())
# Lists of links, told by the rules.
LINK_TAGS = frozenset("menu nav".split())
LINK_WORDS = frozenset("breadcrumb breadcrumbs menu menubar nav navbar navi navigation pager pagination tagcloud toolbar".split())
FURNITURE_TAGS = frozenset("aside button dialog fieldset footer form head header search".split())
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commentary disqus discussion reply replies respond responses".split())
FURNITURE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adbox adsbygoogle advert advertisement adverts alert banner consent cookie cookies copyright disclaimer footer footnav "
    "gdpr header login masthead modal newsletter notice notices notification overlay paywall popup promo promoted promotion "
    "recommended recommendations related search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe "
    "subscription teaser teasers topbar widget widgets".split()
)
# Behind a furniture word, these leave it what it is; any other word names a part of the article.
PART_WORDS = frozenset(
    "article articles button buttons card cards feed icon icons image label link links logo news post posts stories story tag tags "
    "text title titles video videos".split()
)
FILLER_WORDS = frozenset(
    "area bar block bottom box container content form group inner item items left links list main panel right section slot "
    "top unit wrap wrapper zone".split()
)
WIDE_WORDS = frozenset("with has no without layout page".split())
MAIN_TAGS = frozenset(["article", "main"])

SHORT_WORDS = 12  # blocks of fewer words are left to the second pass
STOP_SHARE = 0.12  # of the words of a block of prose
KNOWN_SHARE = 0.2  # of the words of all long blocks, in a listed language; other languages share single words with it
LINK_SHARE = 0.5  # of the words of a block of links

# By word, the numbers of the languages that list it.
_LANGUAGES = {}
for _number, _listed in enumerate(STOP_WORDS.values()):
    for _word in set(_listed.split()):
        _LANGUAGES[_word] = (*_LANGUAGES.get(_word, ()), _number)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW_TAGS})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"'<=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTES = re.compile(r"([^\s\"'=/]+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]+))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _furniture(tag, rest, in_article):
    """'' or why an element is no part of the main text: 'frame', 'comments', or 'header' of an article, with headings only;
    'links' is left to the rules.
    """
    found = {n.lower(): (v or "").strip("\"'") for n, v in _ATTRIBUTES.findall(rest)} if rest else {}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(found.get("style", "")):
        return "frame"
    if found.get("role", "").lower() in FURNITURE_ROLES:
        return "frame"
    if tag in FOREIGN_TAGS:
        return "foreign"
    if tag in FURNITURE_TAGS:
        return "header" if tag == "header" and in_article else "frame"
    if tag in LINK_TAGS:
        return "links"
    if tag in ("html", "body", "h1", "h2", "h3", "h4", "h5", "h6"):
        return ""
    for name in _SPACE.split(f"{found.get('class', '')} {found.get('id', '')}"):
        words = [w for w in re.split(r"[\W_\d]+", _CAMEL.sub("-", name).lower()) if w]
        if not words or WIDE_WORDS & set(words):
            continue
        kernel = [w for w in words if w not in FILLER_WORDS] or words
        if COMMENT_WORDS & set(kernel):
            return "comments"
        if in_article and kernel[-1] == "header":
            return "header"
        if tag in MAIN_TAGS:
            continue
        for listed, why in ((FURNITURE_WORDS, "frame"), (LINK_WORDS, "links")):
            if kernel[-1] in listed or kernel[0] in listed and set(kernel[1:]) <= PART_WORDS | listed:
                return why
    return ""


def _stops(words):
    """How many of the words each language lists."""
    counts = [0] * len(STOP_WORDS)
    for word in words:
        for number in _LANGUAGES.get(word, ()):
            counts[number] += 1
    return counts


_OUTSIDE = ("", "", "", False, False)


def blocks(page):
    """[(text, words, stop words by language, words in links, region, is a heading)] of the page, furniture left out.

    Regions are 'article', 'links' for menus and the like, and '' for the rest of the page.
    """
    out, open_tags = [], []  # open tags: (name, why dropped, region, in a link, in an article's header)
    dropped, inside, link, header = "", "", False, False
    parts, linked = [], 0
    at = 0

    def flush(heading=False):
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                words = _WORDS.findall(text.lower())
                out.append((text, len(words), _stops(words), linked, inside, heading))
        parts, linked = [], 0

    def add(raw):
        nonlocal linked
        if raw and not dropped:
            text = entities.unescape(raw)
            if not header or any(t[0] in ("h1", "h2", "h3") for t in open_tags[-4:]):
                parts.append(text)
                if link:
                    linked += len(_WORDS.findall(text))

    for found in _TOKEN.finditer(page):
        add(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if dropped == "foreign" and tag in BREAKOUT_TAGS and not found["close"]:
            inner = next((k for k, t in enumerate(open_tags) if t[1] == "foreign"), len(open_tags))
            if not any(t[0] in INTEGRATION_TAGS for t in open_tags[inner:]):
                del open_tags[inner:]
                _, dropped, inside, link, header = open_tags[-1] if open_tags else _OUTSIDE
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK_TAGS:
            flush(open_tags[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6") if open_tags else False)
        if found["close"]:
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    del open_tags[k:]
                    break
        elif tag not in VOID_TAGS and not found["rest"].endswith("/"):
            if tag in BLOCK_TAGS and open_tags and open_tags[-1][0] == "p":
                open_tags.pop()  # a paragraph ends where the next block begins
                _, dropped, inside, link, header = open_tags[-1] if open_tags else _OUTSIDE
            why = _furniture(tag, found["rest"], inside == "article")
            if tag in MAIN_TAGS and not why and dropped == "frame":
                dropped = ""  # furniture that was never closed, or a form around the whole page
            headings = header or why == "header"
            why = dropped or (why if why != "header" else "")
            region = "links" if why == "links" or inside == "links" else "article" if tag in MAIN_TAGS and not why else inside
            open_tags.append((tag, "" if why == "links" else why, region, link or tag == "a", headings))
        _, dropped, inside, link, header = open_tags[-1] if open_tags else _OUTSIDE
    add(page[at:])
    flush()
    return out


def decide(found):
    """First pass: True for main text, False for other text, None where a block's own figures don't tell.

    The language of a page counts as known if the best of the listed ones has enough stop words in the long blocks; the
    long blocks of any other page are main text. A block is judged by the language that lists most of its words.
    """
    links = [words and linked > LINK_SHARE * words and not heading for _, words, _, linked, _, heading in found]
    long = [b for b, link in zip(found, links) if not (link or b[1] < SHORT_WORDS or b[5])]
    best = max((sum(n) for n in zip(*(b[2] for b in long))), default=0)
    known = best >= KNOWN_SHARE * sum(b[1] for b in long)
    labels = []
    for (_, words, stops, _, inside, heading), link in zip(found, links):
        if link:
            labels.append(False)
        elif words < SHORT_WORDS or heading:
            labels.append(None)
        elif not known or max(stops) >= STOP_SHARE * words:
            labels.append(True)
        else:
            labels.append(None if inside == "article" else False)
    return labels


def inherit(found, labels):
    """Second pass: an undecided block takes the label of its nearest decided neighbour in its region.

    Of two neighbours as near as each other, one of main text decides. Regions are the article, lists of links and the
    rest of the page. With no neighbour, a block counts as main text inside an article, or outside of lists of links if the
    page has no decided block at all.
    """
    near = [None] * len(found)
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last = {}
        for i in order:
            if labels[i] is not None:
                last[found[i][4]] = i
            elif found[i][4] in last:
                j = last[found[i][4]]
                best = near[i]
                if best is None or abs(i - j) < abs(i - best) or (abs(i - j) == abs(i - best) and labels[j]):
                    near[i] = j
    none = all(x is None for x in labels)
    return [
        (labels[near[i]] if near[i] is not None else found[i][4] == "article" or none and not found[i][4]) if x is None else x
        for i, x in enumerate(labels)
    ]


def main_text(page):
    """The main text of a page, one line a block; '' if there is none. Blocks outside an article count by the same rules.
    """
    found = blocks(page or "")
    return "\n".join(b[0] for b, keep in zip(found, inherit(found, decide(found))) if keep)


def extract(pages, html_col="html", text_col="text"):
    """``pages`` with the main text of each page in ``text_col``, which replaces a column of that name.

    A null or empty page, and one without main text, gives the empty text. Whole pages of any length are read, in time
    proportional to their length. Rows and other columns stay as they are; an empty table stays empty.
    """

    @F.pandas_udf("string")
    def run(column):
        return column.map(main_text, na_action=None)

    return pages.withColumn(text_col, run(F.coalesce(F.col(html_col).cast("string"), F.lit(""))))
