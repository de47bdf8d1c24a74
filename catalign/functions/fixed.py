"""Word lists, patterns, limits and formats that results depend on."""

# --- base-model codes: (brand, code prefixes, family) -----------------------------------------
CODE_FAMILIES = [
    ("SKI-DOO", "LTTA|LTTD|LTTE|LTTF|LTTG|LTTI|LTTS", "MXZ_TRAIL"),
    ("SKI-DOO", "MVTL|MVTA|MVTS|MVTD", "MXZ_CROSSOVER"),
    ("SKI-DOO", "RENE|RENP|RENT|RENX", "RENEGADE"),
    ("SKI-DOO", "BACK|SUMMIT|SUMM", "SUMMIT"),
    ("SKI-DOO", "FREE|FRER|FREX", "FREERIDE"),
    ("SKI-DOO", "GRAN|GTRX|GTRS", "GRAND_TOURING"),
    ("SKI-DOO", "SKAN|EXPE|UTIL", "UTILITY"),
    ("LYNX", "ADVX|ADVE|ADVS", "ADVENTURE"),
    ("LYNX", "COMM|COMO|COMS", "COMMANDER"),
    ("LYNX", "RAVE|RAVX|RAVS", "RAVE"),
    ("LYNX", "XTER|XTRA", "XTRIM"),
]

# --- inheritance -------------------------------------------------------------------------------
BRAND_DEFAULTS = {
    "Ski-Doo": {"suspension": "tMotion", "drive_system": "QRS", "throttle": "electronic"},
    "Polaris": {"suspension": "Pro-Ride", "drive_system": "Team", "throttle": "digital"},
    "Arctic Cat": {"suspension": "ARS II", "drive_system": "TEAM", "throttle": "EFI"},
    "Yamaha": {"suspension": "Dual Shock", "drive_system": "YVXC", "throttle": "EFI"},
}
# model year from which (or, for OLD_YEAR, up to which) values are added
YEAR_UPDATES = [
    (2023, {"display": "digital_gauge", "connectivity": "bluetooth"}),
    (2024, {"starting": "electric_start", "warranty": "3_year_extended"}),
]
OLD_YEAR, OLD_VALUES, OLD_LOSES = 2020, {"display": "analog_gauge"}, "connectivity"
PREMIUM_PRICE, MID_PRICE = 18000, 12000
PRICE_TIERS = {
    "premium": {"heated_grips": "true", "reverse": "electric", "suspension_adjustment": "electronic"},
    "mid": {"heated_grips": "true", "reverse": "manual", "suspension_adjustment": "manual"},
    "entry": {"heated_grips": "false", "reverse": "false", "suspension_adjustment": "fixed"},
}

# --- customization -----------------------------------------------------------------------------
ENGINE_CODES = [
    ("600", {"displacement": "600cc", "engine_type": "2-stroke"}),
    ("800", {"displacement": "800cc", "engine_type": "2-stroke"}),
    ("850", {"displacement": "850cc", "engine_type": "2-stroke"}),
    ("900", {"displacement": "900cc", "engine_type": "4-stroke"}),
    ("1000", {"displacement": "1000cc", "engine_type": "4-stroke"}),
]
TRACK_CODES = [
    ("ST|SPORT", {"track_type": "sport", "track_length": "129"}),
    ("TRAIL", {"track_type": "trail", "track_length": "137"}),
    ("TOURING", {"track_type": "touring", "track_length": "146"}),
    ("MOUNTAIN|MTN", {"track_type": "mountain", "track_length": "155"}),
]
FEATURE_CODES = [
    ("EFI", {"fuel_system": "electronic_fuel_injection"}),
    ("ETEC", {"fuel_system": "e_tec_direct_injection"}),
    ("TURBO", {"forced_induction": "turbocharged"}),
    ("ELECTRIC", {"starting": "electric_start"}),
    ("REVERSE|REV", {"reverse": "manual_reverse"}),
]
VARIANT_CODES = [
    ("Ski-Doo", "RENEGADE", {"model_line": "Renegade", "category": "crossover", "target_use": "versatile"}),
    ("Ski-Doo", "SUMMIT", {"model_line": "Summit", "category": "mountain", "target_use": "deep_snow"}),
    ("Ski-Doo", "MXZ", {"model_line": "MXZ", "category": "performance", "target_use": "trail_performance"}),
    ("Polaris", "ASSAULT", {"model_line": "Assault", "category": "mountain", "target_use": "deep_snow"}),
    ("Polaris", "SWITCHBACK", {"model_line": "Switchback", "category": "trail", "target_use": "trail_riding"}),
]
TRIM_CODES = [
    ("LT|LIMITED", {"trim_level": "limited", "features_level": "premium"}),
    ("X|EXTREME", {"performance_level": "extreme", "target_use": "high_performance"}),
]

# --- options found in codes: (pattern, type, description, confidence) ---------------------------
OPTION_CODES = [
    ("COBRA|CAMSO", "track_upgrade", "Cobra track upgrade", 0.9),
    ("RIPSAW", "track_upgrade", "Ripsaw aggressive track", 0.85),
    ("POWER_?CLAW", "track_upgrade", "Power Claw deep snow track", 0.8),
    ("AIR_RIDE|AIR", "suspension_upgrade", "Air ride suspension upgrade", 0.9),
    ("WALKER_EVANS", "suspension_upgrade", "Walker Evans shock upgrade", 0.85),
    ("FOX", "suspension_upgrade", "Fox Racing shock upgrade", 0.8),
    ("HEATED.*SEAT", "comfort_upgrade", "Heated seat option", 0.9),
    ("WINDSHIELD", "weather_protection", "Windshield upgrade", 0.8),
    ("STORAGE|TUNNEL_BAG", "storage_upgrade", "Storage upgrade", 0.7),
]
# (custom key, value, type, description, confidence, method)
OPTION_RULES = [
    ("track_type", "mountain", "track_upgrade", "Mountain track configuration", 0.7, "customization_analysis"),
    ("suspension_adjustment", "electronic", "suspension_upgrade", "Electronic suspension adjustment", 0.8,
     "customization_analysis"),
    ("features_level", "premium", "comfort_upgrade", "Premium comfort package", 0.6, "customization_analysis"),
    ("performance_level", "extreme", "performance_upgrade", "Extreme performance package", 0.7,
     "seasonal_analysis"),
    ("target_use", "deep_snow", "weather_protection", "Deep snow configuration", 0.8, "seasonal_analysis"),
]
LUXURY_OPTION = ("comfort_upgrade", "Luxury comfort features", 0.6, "price_tier_analysis")

# --- final checks ------------------------------------------------------------------------------
BRAND_PRICES = {"Ski-Doo": (8000, 25000), "Polaris": (7500, 23000), "Arctic Cat": (7000, 22000),
                "Yamaha": (8000, 24000)}
PREMIUM_WORDS = ["turbo", "electronic", "air", "heated"]
SUSPECT_WORDS = ["UNKNOWN", "TEST", "XYZ"]
STAGE_WEIGHTS = [("base_model_matching", 0.3), ("specification_inheritance", 0.2),
                 ("customization_processing", 0.2), ("spring_options_enhancement", 0.1),
                 ("final_validation", 0.2)]

# --- text matching -----------------------------------------------------------------------------
BOOST_WORDS = [
    (0.1, ["summit", "expedition", "renegade", "mxz", "backcountry", "freeride"]),
    (0.05, ["850", "600", "900", "etec", "ace", "turbo"]),
    (0.05, ["expert", "competition", "sport", "adrenaline", "xtreme"]),
]
BOOST_CAP = 0.2
MODEL_SPELLINGS = [("X-RS", "XRS"), ("X RS", "XRS"), ("E-TEC", "ETEC"), ("E TEC", "ETEC"), ("NEO+", "NEO PLUS")]
PACKAGE_WORDS = r"(?i)\b(PACKAGE|WITH|AND)\b"
ENGINE_SHAPE = r"(?i)(\d{3,4})\s*(R?)\s*(E-TEC|ACE|ETEC)\s*(TURBO\s*R?)?"

# ordered rewrites of an upper-cased engine name, as stated; the SQL twins follow them word for word
ENGINE_REWRITES = [
    (r"\bTURBO\s*R\b", "TURBOR"), (r"\bTURBO\s*CHARGED\b", "TURBO"), (r"\bTURBOCHARGED\b", "TURBO"),
    (r"\bE-TEC\b", "ETEC"), (r"\bETEC\b", "ETEC"), (r"\bE\s*TEC\b", "ETEC"),
    (r"\bACE\b", "ACE"), (r"\bA\.C\.E\.\b", "ACE"),
    (r"\bEFI\b", "EFI"), (r"\bE\.F\.I\.\b", "EFI"), (r"\bFUEL\s*INJECTION\b", "EFI"),
    (r"\bWITH\b", ""), (r"\bAND\b", ""), (r"\bOR\b", ""), (r"\bTHE\b", ""),
    (r"[-–—_/\\]", ""), (r"[.:]", ""),
]

# the same in fewer passes, for use on columns; punctuation goes afterwards
ENGINE_WORDS = [
    (r"\bTURBO\s*R\b", "TURBOR"), (r"\bTURBO\s*CHARGED\b", "TURBO"), (r"\bE(-|\s*)TEC\b", "ETEC"),
    (r"\bFUEL\s*INJECTION\b", "EFI"), (r"\b(WITH|AND|OR|THE)\b", ""),
]

# --- price-list headers ------------------------------------------------------------------------
# ordered: (any of these words in the header text, field)
TABLE_HEADERS = [
    (["Tuotenro", "nro"], "model_code"), (["Malli"], "malli"), (["Paketti"], "paketti"),
    (["Moottori"], "moottori"), (["Telamatto"], "telamatto"), (["Käynnistin"], "kaynnistin"),
    (["Mittaristo"], "mittaristo"), (["Kevätoptiot", "optiot"], "kevatoptiot"), (["Väri"], "vari"),
    (["Suositushinta", "ALV"], "price"),
]
KEYWORD_HEADERS = [
    (["tuotenro", "tuote", "koodi"], "model_code"), (["malli", "model"], "model_name"),
    (["paketti", "package"], "package"), (["moottori", "engine", "motor"], "engine"),
    (["telamatto", "track"], "track"), (["käynnistin", "starter"], "starter_type"),
    (["kevätoptiot", "spring", "jousitus"], "spring_options"),
    (["mittaristo", "gauge", "näyttö"], "gauge_type"), (["väri", "color"], "color"),
    (["hinta", "price", "suositus"], "price_eur"),
]
HEADER_KEYWORDS = ["tuotenro", "malli", "paketti", "moottori", "väri", "hinta"]
CATEGORY_ROWS = ["Mid-sized", "Trail", "Deep Snow", "Utility", "Crossover"]
USEFUL_FIELDS = ["malli", "paketti", "moottori", "telamatto", "kaynnistin", "mittaristo", "vari"]
MERGED_FIELDS = ["malli", "paketti", "moottori", "telamatto", "kaynnistin", "mittaristo", "kevatoptiot", "vari"]

# --- line fields of a price-list page (first word found wins) -----------------------------------
LINE_WORDS = {
    "malli": ["Expedition SE", "Expedition Xtreme", "Expedition", "MXZ X-RS", "MXZ", "Summit X", "Summit",
              "Renegade", "Rave RE", "Rave"],
    "paketti": ["X-RS", "RE", "SE", "X", "Sport", "Xtreme"],
    "moottori": ["900 ACE Turbo R", "850 E-TEC Turbo R", "850 E-TEC", "900 ACE", "600R E-TEC", "850R E-TEC",
                 "600 E-TEC"],
    "kaynnistin": ["Electric", "Manual"],
    "mittaristo": ["10.25 in. Color Touchscreen Display", "7.2 in. Digital Display", "4.5 in. Digital Display",
                   "Digital Display", "Touchscreen Display"],
    "vari": ["Terra Green Color Terra Green", "Scandi Blue Color Scandi Blue", "Black", "White", "Red", "Blue",
             "Green", "Yellow", "Terra Green", "Scandi Blue"],
}
OPTION_WORDS = ["Spring", "Option", "Upgrade", "Package"]
PAGE_DISPLAYS = ["10.25 in. Color Touchscreen Display", "7.2 in. Digital Display", "4.5 in. Digital Display"]
PAGE_COLORS = ["Terra Green", "Black", "White", "Red", "Blue", "Yellow"]
PAGE_ENGINES = [("900 ACE Turbo R", 899), ("850 E-TEC Turbo R", 849)]
PAGE_MODELS = [("Expedition SE", "Ski-Doo Expedition SE 900 ACE Turbo R"),
               ("Summit X", "Ski-Doo Summit X 850 E-TEC Turbo R")]
EURO_PRICE = r"(\d{1,3}(?:[\x{a0}.,\s]\d{3})*(?:[.,]\d{2})?)\s*€"

# --- specification pages -----------------------------------------------------------------------
# (letters found, letters that must not follow, model, configuration, category)
PAGE_TITLES = [
    ("SUMMITXWITHEXPERTPACKAGE", None, "Summit X", "Expert Package", "deep-snow"),
    ("SUMMITX", "EXPERT", "Summit X", "Base", "deep-snow"),
    ("SUMMITADRENALINE", None, "Summit Adrenaline", "Base", "deep-snow"),
    ("SUMMITNEO", None, "Summit Neo", "Base", "deep-snow"),
    ("FREERIDE", None, "Freeride", "Base", "deep-snow"),
    ("BACKCOUNTRYXRS", None, "Backcountry X-RS", "Base", "crossover"),
    ("BACKCOUNTRYADRENALINE", None, "Backcountry Adrenaline", "Base", "crossover"),
    ("BACKCOUNTRYSPORT", None, "Backcountry Sport", "Base", "crossover"),
    ("MXZXRSWITHCOMPETITIONPACKAGE", None, "MXZ X-RS", "Competition Package", "trail"),
    ("MXZXRS", "COMPETITION", "MXZ X-RS", "Base", "trail"),
    ("MXZSPORT", None, "MXZ Sport", "Base", "trail"),
    ("MXZNEO", None, "MXZ Neo+", "Base", "trail"),
    ("RENEGADEXRS", None, "Renegade X-RS", "Base", "trail"),
    ("RENEGADEADRENALINE", None, "Renegade Adrenaline", "Base", "trail"),
    ("RENEGADESPORT", None, "Renegade Sport", "Base", "trail"),
    ("EXPEDITIONXTREME", None, "Expedition Xtreme", "Base", "utility"),
    ("EXPEDITIONSE", None, "Expedition SE", "Base", "utility"),
    ("EXPEDITIONLE", None, "Expedition LE", "Base", "utility"),
    ("EXPEDITIONSPORT", None, "Expedition Sport", "Base", "utility"),
    ("GRANDTOURINGSPORT", None, "Grand Touring Sport", "Base", "touring"),
    ("TUNDRALE", None, "Tundra LE", "Base", "utility"),
    ("SKANDICLE", None, "Skandic LE", "Base", "utility"),
    ("SKANDICSPORT", None, "Skandic Sport", "Base", "utility"),
    ("RAVEREWITHENDUROPACKAGE", None, "Rave RE", "Enduro Package", "trail"),
    ("RAVERE", "ENDURO", "Rave RE", "Base", "trail"),
    ("RAVEGLS", None, "Rave GLS", "Base", "trail"),
    ("ADVENTURELIMITED", None, "Adventure Limited", "Base", "touring"),
    ("ADVENTURELX", None, "Adventure LX", "Base", "touring"),
    ("ADVENTUREELECTRIC", None, "Adventure Electric", "Base", "utility"),
    ("ADVENTURECORE", None, "Adventure Core", "Base", "touring"),
    ("ADVENTURE", "LIMITED|LX|ELECTRIC|CORE", "Adventure", "Base", "touring"),
]
PAGE_ENGINE_WORDS = ["ROTAX", "E-TEC", "CYLINDERS", "DISPLACEMENT", "DRY WEIGHT"]
PAGE_MODEL_WORDS = ["SUMMIT", "MXZ", "RENEGADE", "EXPEDITION", "BACKCOUNTRY", "FREERIDE", "TUNDRA", "SKANDIC",
                    "RAVE", "ADVENTURE"]
ENGINE_HEADINGS = [
    r"850 E-TEC[®\s]*TURBO R", r"850 E-TEC[®\s]*", r"600R E-TEC[®\s]*", r"600 EFI[®\s]*–[®\s]*85",
    r"600 EFI[®\s]*–[®\s]*55", r"900 ACE[®\s]*TURBO R", r"900 ACE[®\s]*TURBO", r"900 ACE[®\s]*", r"600 ACE[®\s]*",
]
DIMENSION_LINES = [
    ("overall_length_mm", "overall length", "mm"), ("overall_width_mm", "overall width", "mm"),
    ("overall_height_mm", "overall height", "mm"), ("ski_stance_mm", "ski stance", "mm"),
    ("dry_weight_kg", "dry weight", "kg"),
]
TRACK_LINE = r"(\w+(?:\s+\w+)*)[:\s]*\s*(\d+)\s*x\s*(\d+)\s*x\s*(\d+\.?\d*)"
# TRACK_LINE for Java, whose matcher recurses once per turn of a repeated group and so runs out of stack in long texts. Of a run of words and blanks
# only the first word, or what follows the match before, can start a match: where those fail, all later words do, so each run is tried once.
TRACK_SCAN = r"(?U)(?:\G|(?<![\w\s]))\s*+(\w(?:[\w\s]*\w)?)[:\s]*+(\d++)\s*+x\s*+(\d++)\s*+x\s*+(\d++\.?\d*+)"
TABLE_SIGNS = ["Model", "Price", "Code", "EUR", "Specifications", "\t", "  ", "|", "Engine", "Track", "Weight"]

# --- whitelist and field rules -------------------------------------------------------------------
WHITELIST_SHAPES = [
    ".*SUMMIT.*", ".*MXZ.*", ".*BACKCOUNTRY.*", ".*RENEGADE.*", ".*EXPEDITION.*", ".*FREERIDE.*",
    ".*GRAND.?TOURING.*", ".*LYNX.*ADVENTURE.*", ".*LYNX.*RAVE.*", ".*LYNX.*RANGER.*", ".*LYNX.*XTRIM.*",
    ".*LYNX.*BOONDOCKER.*",
]
MIN_PRICE, MAX_PRICE = 100000, 10000000
CURRENCIES = ["EUR", "RUB"]
CODE_SHAPE = "^[A-Z]{4}$"
KNOWN_BRANDS = ["BRP", "LYNX", "SKI-DOO"]
YEAR_RANGE = (2015, 2030)
ENGINE_FAMILIES = [
    ("SUMMIT", ["600", "850"]), ("MXZ", ["600", "850"]), ("RENEGADE", ["600", "850"]), ("EXPEDITION", ["900"]),
    ("GRAND TOURING", ["900"]), ("LYNX ADVENTURE", ["600", "900"]), ("LYNX RAVE", ["600", "850"]),
    ("LYNX RANGER", ["600", "900"]),
]
BRAND_FAMILIES = {
    "SKI-DOO": ["SUMMIT", "MXZ", "RENEGADE", "EXPEDITION", "FREERIDE", "BACKCOUNTRY", "GRAND TOURING"],
    "LYNX": ["ADVENTURE", "RAVE", "RANGER", "XTRIM", "BOONDOCKER"],
}
MARKET_CURRENCY = {"FINLAND": "EUR", "RUSSIA": "RUB"}
MARKET_FIELDS = {"FINLAND": ["telamatto", "kaynnistin"]}
TITLE_RULES = {"min": 10, "max": 200, "required": ["BRP"], "forbidden": ["test", "demo"]}
DESCRIPTION_RULES = {"min": 50, "max": 9000}

HINT_SHAPES = [
    ("numeric", "(число|цифр|numeric|number)"), ("required", "(обязательн|required|must)"),
    ("length_limit", "(длин|length|символ|character)"), ("format_specific", "(формат|format|pattern)"),
    ("url", "(url|ссылк|link)"), ("phone", "(телефон|phone)"), ("email", "(email|почт)"),
    ("currency", "(рубл|руб|currency|price)"), ("range", "(от|до|from|to|range|диапазон)"),
]

LISTING_EXACT = {
    "Category": "Мотоциклы и мототехника", "VehicleType": "Снегоходы", "Make": "BRP", "EngineType": "Бензин",
    "Condition": "Новое", "Kilometrage": "0", "Address": "Санкт-Петербург",
}
LISTING_EXACT_TAIL = {"Make": " for BRP snowmobiles", "Condition": " for new snowmobiles",
                      "Kilometrage": " for new snowmobiles"}
LISTING_TYPES = ["Утилитарный", "Спортивный или горный", "Туристический", "Детский", "Мотобуксировщик"]
LISTING_STOCK = ["В наличии", "Под заказ", "Нет в наличии"]
LISTING_TERMS = ["снегоход", "ski-doo", "lynx", "brp", "мотоснегокат"]
IMAGE_ENDINGS = [".jpg", ".jpeg", ".png", ".webp"]

# --- golden values -------------------------------------------------------------------------------
BRAND_SIGNS = {
    "Ski-Doo": {"codes": ["AYTS", "AYRN", "AYSE", "AYSH", "AYTG", "AYTR", "AYTP"],
                "families": ["Expedition SE", "Expedition LE", "Expedition Xtreme"],
                "engines": ["900 ACE Turbo R", "900 ACE Turbo"]},
    "Lynx": {"codes": ["LTTA", "LFSA", "LFSE", "SZSP", "SMSA"],
             "families": ["Commander RE", "Brutal RE", "Xterrain RE"],
             "engines": ["900 ACE Turbo R", "850 E-TEC"]},
}
PRICE_RANGES = [("model_code", "AYTS", 24000.0, 26000.0), ("model_family", "Expedition SE", 20000.0, 30000.0),
                ("engine", "900 ACE Turbo R", 18000.0, 35000.0)]
FABRICATED_WORDS = ["fake_", "mock_", "dummy_", "test_123", "example_"]
SLOTS = ["03:00", "11:00", "19:00"]
SLOT_MINUTES = 60
LANGUAGES = [("fi", "Finnish", "EUR", "FI"), ("se", "Swedish", "SEK", "SE"), ("no", "Norwegian", "NOK", "NO"),
             ("dk", "Danish", "DKK", "DK"), ("en", "English", "EUR", "International")]
INPUT_COST_PER_MILLION, OUTPUT_COST_PER_MILLION = "0.25", "1.25"
