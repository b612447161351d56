"""Labels, word lists, codes and patterns a result has to carry verbatim."""

# ---- Fixed values: result contract ----------------------------------------------------
RESULT_COLUMNS = ("indicateur", "indicateur_parent", "maille", "maille_parent", "valeur")

# ---- Fixed values: organisation levels and unit-group labels ---------------------------
ORG_LEVELS_6 = ("direction", "division", "regroupement_unite", "um", "dum", "code_moa")
ORG_LEVELS_5 = ("direction", "division", "um", "dum", "code_moa")
ORG_LEVELS_3 = ("um", "dum", "code_moa")
UNIT_GROUP_6 = "groupes mailles direction/division/regroupement_unite/um/dum/code rc"
UNIT_GROUP_5 = "groupes mailles direction/division/um/dum/code rc"
UNIT_GROUP_3 = "groupes mailles um/dum/code rc"
PATH_SEPARATOR = "/"

# ---- Fixed values: parenthesised codes --------------------------------------------------
CODE_LAST_PAREN = r"(?s).*\((.*)\)"
CODE_GREEDY_PAREN = r"(?s)\((.*)\)"
CODE_FIRST_PAREN = r"(?s)\((.*?)\)"

# ---- Fixed values: generic (shared) accounts, tested in this order ----------------------
GENERIC_ACCOUNT_MARKS = ("-OP", "AUTRE", "-G", "-PR", "CSP")
GENERIC_ACCOUNT = "Exclu"
PERSONAL_ACCOUNT_LENGTHS = (6, 8)
NOT_A_SERVICE_ACCOUNT = "PAS DE SERVICE"

# ---- Fixed values: markers in source data -----------------------------------------------
NETWORK_DISCONNECTED = "Hors RLE"
LOCATION_RIGHT = "Juste"
UNKNOWN_LABEL = "inconnu"
SEEN, NOT_SEEN, NEVER_SEEN = "vu", "pas vu", "jamais vu"

# ---- Fixed values: comparison codes -----------------------------------------------------
CODE_EQUAL, CODE_DIFFERENT, CODE_MISSING, CODE_NOT_APPLICABLE = 1, 2, 3, 4

# ---- Fixed values: compliance -----------------------------------------------------------
# (text contained in the configuration item name, element label), first match wins
COMPLIANCE_ELEMENTS = (
    ("Chiffrement", "Chiffrement"),
    ("Compte et groupe", "Compte de groupe"),
    ("Antivirus", "Antivirus"),
    ("Poste", "Poste"),
    ("Réseau", "Réseau"),
    ("WSUS", "WSUS"),
    ("SCCM", "SCCM"),
)
STATUS_OK = "compliant"
STATUS_KO = "noncompliant"
STATUS_FAILED = ("error", "notapplicable", "notdetected")

# ---- Fixed values: patch state codes ----------------------------------------------------
STATE_ERROR = (2, 4)
STATE_UP_TO_DATE = (3,)
STATE_REBOOT = (5,)
STATE_RUNNING = (7,)
STATE_UNSEEN = (8,)
CAMPAIGN_DONE = 3
CAMPAIGN_NOT_TARGETED = 2

# ---- Fixed values: patch campaigns ------------------------------------------------------
CAMPAIGN_KIND = "P"
CAMPAIGN_WINDOW_DAYS = 60
CAMPAIGN_SCAN_DAYS = 30
# group marker -> (days after the start, milestone label) in the order they are tested
CAMPAIGN_MILESTONES = (
    ("G2", ((56, "G2 8"), (42, "G2 6"))),
    ("G3", ((28, "G3 4"), (21, "G3 3"))),
)

# ---- Fixed values: operating systems ----------------------------------------------------
OS_VENDOR_PREFIX = "MICROSOFT "
OS_SPELLINGS = ("ENTREPRISE", "ENTERPRISE")
OS_VENDOR_IN_NAME = "Microsoft.? "
LTSC_MARK = "LTSC"
# extended-support product groups: product group -> suffix of the commercial name
EXTENDED_SUPPORT = {
    "AF126CAE-171C-4329-B1AB-D70F55CA7EEA": " ESU Year 1",
    "5BE7EFCD-462C-4B18-9FEA-B6F7A4B7B71A": " ESU Year 2",
    "C62D695A-19F2-42DB-B732-5BFB503BDEC0": " ESU Year 3",
    "66678789-058A-4DDF-B658-1698405CA5B2": " ESU Year 1",
    "0110AA20-8307-4A4A-A91C-A8EB790714FF": " ESU Year 2",
    "A016C6E2-83F4-4086-9CD4-82FAB8418F7E": " ESU Year 3",
}
SUPPORT_CLASSES = {0: "non", 1: "6 mois", 2: "oui"}
# cleaning of a full OS name, applied in this order: (pattern, replacement)
OS_NAME_CLEANING = (
    ("(Entreprise)", "Enterprise"),
    (r"(?U)[^\w\s\.]", ""),
    ("(Microsoft|Ã¢â€žÂ¢|Ã‚Â®|2016)", ""),
)
OS_NAME_PARTS = r"(?U)(\S+)\s+(\S+)\s+(\S+)\s*(\S*)$"
MONTHLY_OS_LABELS = "nombre de postes avec (OS|support|licence|LTSC)"

# ---- Fixed values: retention ------------------------------------------------------------
DAILY_RETENTION_MONTHS = 2
MONTHLY_RETENTION_MONTHS = 12

# ---- Fixed values: recency thresholds (days) ---------------------------------------------
FRESH_DAYS = 8
WINDOW_DAYS = 31
STALE_DAYS = 61
