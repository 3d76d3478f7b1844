"""Fixed lists the filters and adapters need."""

# Languages substituted for {lan} in URL prefixes.
WIKI_LANGUAGES = ["ar", "br", "ca", "co", "de", "en", "es", "eu", "fr", "frp", "it", "nl", "oc", "pcd", "pt"]

# URL prefixes of sources that the corpus already holds in a curated form.
KNOWN_URL_PREFIXES = [
    "360info.org", "africasacountry.com/", "www.altnews.in/", "balkandiskurs.com/en/", "factly.in/",
    "freedom.press/", "www.fides.org/en", "globalvoices.org/", "meduza.io/en", "www.mekongeye.com/",
    "milwaukeenns.org/", "minorityafrica.org/", "www.newcanadianmedia.ca/", "www.scidev.net/global/",
    "sojoexchange.solutionsjournalism.org/", "www.tasnimnews.com/en", "zimfact.org/", "oxpeckers.org/",
    "www.propastop.org/en/", "thepublicrecord.ca/",
    "www.ncbi.nlm.nih.gov/pmc", "irclogs.ubuntu.com", "www.biodiversitylibrary.org/", "static.case.law",
    "stackexchange.com", "www.foodista.com", "tile.loc.gov", "libretexts.org", "oercommons.org",
    "babel.hathitrust.org", "openoregon.pressbooks.pub", "publicdomainreview.org/", "uspto.gov",
    "downloads.regulations.gov", "www.parliament.uk", "www.govinfo.gov", "raw.githubusercontent.com",
    "exporter.nih.gov", "courtlistener.com", "philpapers.org",
    "aleph.gutenberg.org", "arxiv.org", "echanges.dila.gouv.fr/OPENDATA/", "github.com",
    "www.gutenberg.org", "hal.science", "openedition.org", "www.statmt.org/europarl", "theses.fr",
    "youtube.com",
    "{lan}.wikipedia", "{lan}.wiktionary", "{lan}.wikisource", "{lan}.wikibooks", "{lan}.wikinews",
    "{lan}.wikiquote", "{lan}.wikiversity", "{lan}.wikivoyage", "op.europa.eu/{lan}/",
    "op.europa.eu/{lan}/web/cellar",
    "www.amf-france.org/{lan}/news-publications/publications/open-data", "ted.europa.eu/{lan}/",
    "eur-lex.europa.eu/homepage.html?locale={lan}", "digitallibrary.un.org/?ln={lan}", "archives.eui.eu",
    "www.consilium.europa.eu/{lan}/general-secretariat/corporate-policies/transparency/open-data/",
    "www.oecd.org/{lan}/data/datasets.html",
]

# Fixed values: (web-crawl code, two-letter code or None, three-letter code).
LANGUAGES = [
    ("eng_Latn", "en", "eng"),
    ("acf_Latn", None, "acf"),
    ("bre_Latn", "br", "bre"),
    ("cos_Latn", "co", "cos"),
    ("deu_Latn", "de", "deu"),
    ("fra_Latn", "fr", "fra"),
    ("frp_Latn", None, "frp"),
    ("gcr_Latn", None, "gcr"),
    ("nld_Latn", "nl", "nld"),
    ("pcd_Latn", None, "pcd"),
    ("rcf_Latn", None, "rcf"),
    ("tah_Latn", "ty", "tah"),
    ("arb_Arab", "ar", "arb"),
    ("cat_Latn", "ca", "cat"),
    ("crs_Latn", None, "crs"),
    ("eus_Latn", "eu", "eus"),
    ("gcf_Latn", None, "gcf"),
    ("ita_Latn", "it", "ita"),
    ("oci_Latn", "oc", "oci"),
    ("por_Latn", "pt", "por"),
    ("spa_Latn", "es", "spa"),
    ("wln_Latn", "wa", "wln"),
]

# Metadata that never reaches the published record.
INTERNAL_KEYS = ["file_path", "pii_email", "pii_ip", "pii_phone"]


def expand_prefixes(prefixes: list[str], languages: list[str] = WIKI_LANGUAGES) -> list[str]:
    """Replace each ``{lan}`` entry by one prefix per language, keeping the order."""
    out: list[str] = []
    for prefix in prefixes:
        out.extend([prefix.replace("{lan}", lan) for lan in languages] if "{lan}" in prefix else [prefix])
    return out


def language_map(source: str, target: str) -> dict[str, str]:
    """Code mapping between ``web``, ``iso1`` and ``iso3``.

    A language without a two-letter code goes by its three letters there.
    """
    column = {"web": 0, "iso1": 1, "iso3": 2}
    pairs = [(row[column[source]], row[column[target]] or row[2]) for row in LANGUAGES]
    return {a: b for a, b in pairs if a is not None and b is not None}
