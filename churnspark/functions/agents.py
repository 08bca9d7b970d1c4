"""Agent strings read by their grammar: products with versions, and the parts of comments.

An agent is a list of products, ``name/version``, with comments in parentheses whose parts are
separated by semicolons. Platform and browser follow from whole products and from how comment parts
begin, not from text anywhere in the string: a device called "Windowsill" is no Windows, and
"like Mac OS X" inside a part names no platform.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered rules, first match wins. A part of a comment matches if its first words are
# those of the rule; a product matches by its name.
PLATFORM_PARTS = (
    ("Windows Phone", ("Windows Phone", "Windows Phone OS")),
    ("iOS", ("iPhone", "iPad", "iPod", "iPod touch")),
    ("Android", ("Android",)),
    ("BlackBerry", ("BlackBerry", "BB10", "PlayBook")),
    ("PlayStation", ("PlayStation", "PLAYSTATION")),
    ("Xbox", ("Xbox",)),
    ("Nintendo", ("Nintendo",)),
    ("ChromeOS", ("CrOS",)),
    ("Windows", ("Windows", "Windows NT")),
    ("Mac OS", ("Macintosh", "Mac OS X")),
    ("FreeBSD", ("FreeBSD",)),
    ("Linux", ("Linux", "X11")),
)
BROWSER_PRODUCTS = (
    ("Microsoft Edge", ("Edge", "Edg", "EdgA", "EdgiOS")),
    ("Opera Mini", ("Opera Mini",)),
    ("Opera", ("OPR", "Opera")),
    ("UC Browser", ("UCBrowser", "UCWEB")),
    ("Samsung Browser", ("SamsungBrowser",)),
    ("BlackBerry Browser", ("BlackBerry", "BB10", "PlayBook")),
    ("Nintendo Browser", ("NintendoBrowser",)),
    ("Chrome", ("Chrome", "CriOS")),
    ("Firefox", ("Firefox", "FxiOS")),
    ("Microsoft Internet Explorer", ("MSIE", "Trident", "IEMobile")),
    ("Safari", ("Safari",)),
)
# What these products say is the browser's own version.
VERSION_PRODUCT = {
    "Safari": "Version", "Opera": "Version", "BlackBerry Browser": "Version", "Microsoft Internet Explorer": "rv",
}

TOKEN = "struct<kind: string, name: string, version: string>"
_COMMENT = r"\(([^()]*)\)"


def _trimmed(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def _named(text: Column, kind: str) -> Column:
    """A token from ``name/version``; a name without one has a null version."""
    cut = F.split(text, "/", 2)
    version = F.try_element_at(cut, F.lit(2))
    return F.struct(F.lit(kind).alias("kind"), F.get(cut, F.lit(0)).alias("name"), version.alias("version")).cast(TOKEN)


def _part(text: Column) -> Column:
    """A token from a part of a comment: ``name/version``, ``rv:version``, or words with a last one that begins with a digit."""
    version = F.regexp_extract(text, r"^(.*?)[ /:]([0-9][^ ;]*)$", 2)
    name = F.regexp_extract(text, r"^(.*?)[ /:]([0-9][^ ;]*)$", 1)
    has = version != ""
    return F.struct(
        F.lit("part").alias("kind"), F.when(has, name).otherwise(text).alias("name"), F.when(has, version).alias("version")
    ).cast(TOKEN)


def agent_tokens(agent: Column) -> Column:
    """The tokens of an agent string: products in order, then the parts of all comments.

    A null agent has null tokens. A parenthesis that is not closed is no comment; of nested
    ones the inner are read. "Opera Mini/8" is one product, although its name has a blank.
    """
    comments = F.flatten(
        F.transform(F.regexp_extract_all(agent, F.lit(_COMMENT), F.lit(1)), lambda c: F.split(c, ";"))
    )
    products = F.regexp_replace(F.regexp_replace(agent, _COMMENT, " "), "Opera Mini", "Opera_Mini")
    named = F.transform(_trimmed(F.split(products, " ")), lambda p: _named(F.replace(p, F.lit("_"), F.lit(" ")), "product"))
    return F.concat(named, F.transform(_trimmed(comments), _part))


def _first_rule(rules: Sequence[tuple[str, Sequence[str]]], matches) -> Column:
    return F.coalesce(*[F.when(matches(parts), F.lit(name)) for name, parts in rules])


def platform_of(tokens: Column) -> Column:
    """The first platform rule that a part of a comment begins with; null when none does."""

    def matches(parts: Sequence[str]) -> Column:
        def begins(token: Column) -> Column:
            name = F.concat(token["name"], F.lit(" "))
            found = [name.startswith(f"{p} ") for p in parts]
            return (token["kind"] == "part") & _any(found)

        return F.exists(tokens, begins)

    return _first_rule(PLATFORM_PARTS, matches)


def browser_of(tokens: Column) -> Column:
    """The first browser rule with a product of that name (or a part of a comment, as old browsers have it)."""

    def matches(names: Sequence[str]) -> Column:
        return F.exists(tokens, lambda t: t["name"].isin(list(names)))

    return _first_rule(BROWSER_PRODUCTS, matches)


def version_of(tokens: Column, browser: Column) -> Column:
    """The version of the recognised browser, as its product (or the product that holds it) says."""

    def version(names: Sequence[str]) -> Column:
        of = F.filter(tokens, lambda t: t["name"].isin(list(names)) & t["version"].isNotNull())
        return F.get(of, F.lit(0))["version"]

    found = []
    for name, products in BROWSER_PRODUCTS:
        own = version(products)
        if name in VERSION_PRODUCT:
            # Internet Explorer names its version as MSIE, later as rv; the engine's comes last.
            first = version([p for p in products if p == "MSIE"]) if "MSIE" in products else F.lit(None).cast("string")
            own = F.coalesce(first, version([VERSION_PRODUCT[name]]), own)
        found.append(F.when(browser == name, own))
    return F.coalesce(*found)


def _any(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined | condition
    return combined
