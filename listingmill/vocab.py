"""Word lists and patterns the listing rules are defined by.

Fixed values: results depend on these exact words, so they are kept as plain
text in one place.  Everything that *uses* them lives in the operators.
"""

# --- availability -----------------------------------------------------------
AVAILABLE_NOW = ("sofort", "immediately")
AVAILABLE_ON_AGREEMENT = ("nach Vereinbarung", "by arrangement", "by agreement")
AGREEMENT_DELAY_DAYS = 30

# --- floor ------------------------------------------------------------------
FLOOR_BASEMENT = ("ug", "basement")
FLOOR_GROUND = ("eg", "erdgeschoss", "ground floor")
TITLE_HOUSE = ("haus", "villa", "house")
DESC_GROUND = ("erdgeschoss", "eg", "ground floor")
DESC_BASEMENT = ("untergeschoss", "ug", "basement")
LEVEL_WORDS = ("og", "obergeschoss", "etage", "stock", "floor", "level")
TITLE_SHOP = ("laden", "büro", "store", "office")

# --- rooms ------------------------------------------------------------------
SINGLE_ROOM_TITLE = (
    "büro", "studio", "gewerbe", "lager", "hobbyraum", "hobby", "laden",
    "ladenfläche", "office", "commercial", "storage", "shop", "retail",
    "workspace",
)

# --- location text ----------------------------------------------------------
CITY_TRAILING_VERBS = (
    "erwartet", "liegt", "befindet", "steht", "wurde", "bietet", "is",
    "offers", "located", "found",
)
ADDRESS_NOISE = (
    "zone", "quartier", "proche", "village", "situation", "maison",
    "immeuble", "appartement", "au calme.*",
)
COUNTRY = "Switzerland"

# --- area -------------------------------------------------------------------
AREA_UNITS = ("m²", "m2", "quadratmeter", "square meters", "sqm")

# --- rental or sale ---------------------------------------------------------
RENTAL_WORDS = ("miete", "vermietet", "zur miete", "monatlich", "rental", "rent", "per month")
SALE_WORDS = (
    "kaufen", "kauf", "verkauf", "zum kauf", "einmalig", "kaufpreis", "buy",
    "purchase", "one-time",
)
RENTAL_PRICE_LIMIT = 20_000

# --- amenities: French, German, English, Italian ----------------------------
AMENITIES = {
    "is_new": (
        "neuf", "neuve", "neufs", "neuves", "neufve", "neufves", "nouveau",
        "nouvelle", "rénové", "rénovée", "rénovées", "rénovation", "moderne",
        "restauré", "restaurée", "restaurées", "restauration", "refait",
        "refaite", "refaites", "refait à neuf",
        "neu", "neues", "neuer", "neuem", "neuen", "modern", "modernisiert",
        "renoviert", "saniert", "erneuert", "restauriert", "neubau", "neubauten",
        "new", "renovated", "renewed", "refurbished", "restored",
        "recently renovated", "brand new", "fully renovated", "newly built",
        "new build",
        "nuovo", "nuova", "nuovi", "nuove", "moderno", "moderna", "moderni",
        "rinnovato", "rinnovata", "rinnovati", "rinnovate", "ristrutturato",
        "ristrutturata", "ristrutturati", "ristrutturate", "restaurato",
        "restaurata", "restaurati", "restaurate",
    ),
    "has_view": (
        "vue", "panoramique", "imprenable", "dégagée", "sur lac",
        "sur montagne", "sur jardin", "sur parc", "vue mer", "vue montagne",
        "vue lac",
        "aussicht", "blick", "panoramablick", "seeblick", "bergsicht",
        "gartenblick", "parkblick", "meerblick",
        "view", "panoramic", "unobstructed",
        "vista", "panoramica", "vista lago",
    ),
    "has_garden": (
        "jardin", "parc", "pelouse", "verger",
        "garten", "park", "rasen", "obstgarten",
        "garden", "lawn", "orchard",
        "giardino", "parco", "prato", "frutteto",
    ),
    "has_parking": (
        "parking", "garage", "stationnement", "place de parc", "box",
        "parkplatz", "stellplatz", "carport",
        "parking space",
        "parcheggio", "posto auto",
    ),
    "has_air_conditioning": (
        "climatisation", "climatiseur", "air conditionné",
        "klimaanlage", "klimagerät", "air conditioning",
        "ac", "air conditioner",
        "aria condizionata", "condizionatore", "climatizzazione",
    ),
}

# --- boosted-model preparation ----------------------------------------------
COMMERCIAL_WORDS = (
    "gewerbe", "lager", "hobby", "büro", "praxis", "industrie", "atelier",
    "geschäftslokal", "werkstatt",
)
KEYWORDS = (
    "luxus", "renoviert", "neubau", "altbau", "hochwertig", "modern",
    "barrierefrei", "parkett", "panoramafenster", "einbauküche",
    "naturstein", "quooker", "wärmepumpe", "photovoltaik", "kamin",
    "begehbar", "regendusche", "grosszügig", "hell", "lichtdurchflutet",
    "offen", "bodenheizung", "terrasse", "balkon", "garten", "loggia",
    "e-mobilität", "aufzug", "garage", "tiefgarage", "klimatisiert",
    "aktionspreis", "rabatt", "erstbezug", "sommer-aktion", "ruhig",
    "zentral", "aussicht", "rheinnähe", "altstadt", "autofrei",
)

# --- text features ----------------------------------------------------------
# English function words; callers may pass any other list.
STOP_WORDS = (
    "a", "about", "above", "after", "again", "against", "all", "am", "an",
    "and", "any", "are", "as", "at", "be", "because", "been", "before",
    "being", "below", "between", "both", "but", "by", "can", "could", "do",
    "down", "during", "each", "few", "for", "from", "further", "had", "has",
    "have", "he", "her", "here", "hers", "him", "his", "how", "i", "if", "in",
    "into", "is", "it", "its", "itself", "me", "more", "most", "my", "no",
    "nor", "not", "now", "of", "off", "on", "once", "only", "or", "other",
    "our", "ours", "out", "over", "own", "same", "she", "should", "so",
    "some", "such", "than", "that", "the", "their", "them", "then", "there",
    "these", "they", "this", "those", "through", "to", "too", "under",
    "until", "up", "very", "was", "we", "were", "what", "when", "where",
    "which", "while", "who", "whom", "why", "will", "with", "would", "you",
    "your", "yours",
)

# --- scoring requests -------------------------------------------------------
REQUEST_REQUIRED = ("mode", "area", "floor", "rooms", "lat", "lon", "zip_code", "city", "region")
REQUEST_FLAGS = (
    "has_balcony", "has_view", "has_garden", "has_parking",
    "has_air_conditioning", "is_new",
)
REQUEST_DEFAULT_DATE = "2025-01-01"
