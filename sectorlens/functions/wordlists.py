"""Word lists, templates' vocabularies and class names.

Everything in this module is data that has to equal published values for the
results to be right.  Nothing here is computed.
"""

from __future__ import annotations

# Common English stop words, compared case-sensitively.
STOP_WORDS_EN: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your
    yours yourself yourselves he him his himself she she's her hers herself it
    it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above
    below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no
    nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
    mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn
    wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Markers whose line tail is boilerplate, applied in this order.
BOILERPLATE_MARKERS: tuple[str, ...] = (
    "cookie",
    " login ",
    " log in ",
    "register for free",
)

# Sectors reported with the energy report family; every other
# sector belongs to the utilities family.
ENERGY_SECTORS: tuple[str, ...] = (
    "Coking Coal",
    "Natural Gas",
    "Oil & Gas Drilling",
    "Oil & Gas E&P",
    "Oil & Gas Equipment & Services",
    "Oil & Gas Integrated",
    "Oil & Gas Midstream",
    "Oil & Gas Refining & Marketing",
    "Shale Oil",
    "Thermal Coal",
)

# Geography names folded into a region; others keep their name.
REGION_OF_GEO: dict[str, str] = {
    "Yukon": "Northern Territories",
    "Northwest Territories": "Northern Territories",
    "Nunavut": "Northern Territories",
    "Prince Edward Island": "Atlantic Provinces",
    "Nova Scotia": "Atlantic Provinces",
    "New Brunswick": "Atlantic Provinces",
}

# Labels spread around the circle on the map, in angle order.
BALANCE_LABELS: tuple[str, ...] = (
    "Gas Input MJ",
    "Gas Output MJ",
    "Crude Input MJ",
    "Crude Output MJ",
    "Coal Input MJ",
    "Coal Output MJ",
)

# Default verb lexicons per language for the verb-bearing line filter.  They
# stand in for a trained tagger; callers pass their own for real corpora.
VERB_WORDS: dict[str, tuple[str, ...]] = {
    "en": (
        "am", "is", "are", "was", "were", "be", "been", "being",
        "have", "has", "had", "do", "does", "did",
        "will", "would", "can", "could", "shall", "should", "may", "might", "must",
        "say", "says", "said", "make", "makes", "made", "go", "goes", "went",
        "take", "takes", "took", "get", "gets", "got", "see", "sees", "saw",
    ),
    "fr": ("est", "sont", "était", "être", "a", "ont", "avait", "avoir", "fait", "peut", "va"),
    "de": ("ist", "sind", "war", "waren", "sein", "hat", "haben", "hatte", "wird", "werden", "kann"),
    "es": ("es", "son", "era", "eran", "ser", "está", "ha", "han", "había", "puede", "hace"),
}
VERB_SUFFIXES: dict[str, tuple[str, ...]] = {
    "en": ("ed", "ing"),
    "fr": ("er", "ait", "ent"),
    "de": ("en", "te"),
    "es": ("ar", "aba", "ido"),
}

# Default sentiment lexicon for the deterministic scorer.
POSITIVE_WORDS: tuple[str, ...] = (
    "gain", "gains", "growth", "improve", "improved", "increase", "increased",
    "profit", "profits", "record", "rise", "rises", "rose", "strong", "success",
)
NEGATIVE_WORDS: tuple[str, ...] = (
    "cut", "cuts", "decline", "declined", "decrease", "decreased", "drop", "fall",
    "fell", "loss", "losses", "risk", "risks", "weak", "shutdown",
)
