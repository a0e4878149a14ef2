"""Fixed values of the laboratory rules."""

# Raw unit spellings and the unit they stand for.
RAW_UNITS: list[tuple[str, list[str]]] = [
    ("/100{WBCs}", ["/100 WBC", "/100 WBCS", "/100(WBCs)", "/100 wbc", "/100WBC", "/100wbc"]),
    ("s", ["second(s)", "SECONDS", "Seconds"]),
    ("/[HPF]", ["/HPF", "/hpf"]),
    ("/[LPF]", ["/LPF"]),
    ("mm/h", ["mm/hr", "MM/HR", "mm/Hr", "MM/Hr", "mm/1hr"]),
    ("mg/(24.h)", ["mg/24hr", "mg/day"]),
    ("g/(24.h)", ["g/day"]),
    ("%{vol}", ["vol %"]),
    ("Cel", ["CELSIUS"]),
    ("{cells}/uL", ["cells/uL", "cells/ul", "cell/uL"]),
    ("mm[Hg]", ["mmHg", "mmHG", "mmHG."]),
    ("10*3/uL", ["THOU/uL", "Thousand/uL", "THOU/ul", "10 3/uL", "th/uL", "Thousands/uL", "thousand/u;",
                 "Thou/uL", "thou/uL", "THOUS/MCL", "thous/mcL", "thousand/ul", "K/mm3", "k/mm3"]),
    ("10*6/uL", ["10 6/uL", "MIL/uL", "mil/uL", "MILL/MCL", "mill/mcL", "Mill/uL", "mill/uL", "Million/uL",
                 "million/ul", "x10E6/uL", "M/mm3", "m/mm3"]),
    ("ug/dL", ["mcg/dL", "MCG/DL", "mcg/dl", "mcg/dL (calc)"]),
    ("mg/dL", ["mg/dL"]),
    ("%", ["%"]),
    ("/mm3", ["/mm3"]),
    ("10*-3.eq/L", ["mEq/L"]),
    ("fL", ["fL"]),
    ("g/dL", ["g/dL"]),
    ("[IU]/L", ["IU/L"]),
    ("pg", ["pg"]),
    ("ng/mL", ["ng/mL"]),
    ("mmol/L", ["mmol/L"]),
]

# Which units count as unknown.
UNKNOWN_UNITS = ["OT", "", "NI", "UN"]
UNMAPPED_UNITS = ["", "OT", "NI"]

# Tests reported in pH and tests reported as a ratio.
PH_CODES = ["11558-4", "2749-0", "5803-2", "2746-6"]
PH_NAMES = ["ph of venous blood", "ph of blood", "ph of urine by test strip", "ph of gastric fluid",
            "ph of capillary blood"]
RATIO_CODES = ["5811-5", "1759-0", "2965-2", "6301-6"]
RATIO_NAMES = ["inr in platelet poor plasma by coagulation assay", "specific gravity of urine",
               "specific gravity of urine by test strip", "albumin/globulin [mass ratio] in serum or plasma"]

# Absolute cell counts given per microlitre and their unit in thousands.
ABSOLUTE_COUNT_CODES = ["704-7", "731-0", "743-5", "742-7", "26499-4", "751-8"]
PER_MICROLITRE = ["uL", "/uL", "{#}/uL", "{cells}/uL", "/mm3"]
THOUSANDS_UNIT = "10*3/uL"

# White-cell test code that is replaced in blood specimens.
WHITE_CELL_CODE, WHITE_CELL_BLOOD_CODE, BLOOD = "20584-9", "26464-8", "BLD"

# Range operators (concept ids) and the modifier pair they stand for, in order.
RANGE_PAIRS: list[tuple[list[int], list[int], str]] = [
    ([4171754, 4172703, 4171755], [4172703, 4171755, 4171754, 4171756], "GE|NO"),
    ([4171754, 4171756], [4172703, 4171755, 4171756], "GT|NO"),
    ([4171755, 4172704], [4172703, 4171756], "NO|LE"),
    ([4172703, 4172704, 4171754, 4171756], [4172704], "NO|LT"),
]

# Repair steps for (result, low, high) modifiers, in order: the accepted values of the three, their new
# values (None keeps), and whether the low and the high bound must be there (None: either way).
MODIFIER_REPAIRS: list[tuple] = [
    (("EQ",), ("LT", "LE"), ("OT",), None, "EQ", "EQ", None, None),
    (("GE",), ("LT", "LE"), ("OT",), None, "GE", "NO", None, None),
    (("EQ",), ("OT",), ("GE", "GT"), None, "EQ", "EQ", None, None),
    (("GE",), ("OT",), ("GE",), None, "GE", "NO", None, None),
    (("OT",), ("OT",), ("GT",), "GT", "GT", "NO", None, None),
    (("LT",), ("OT",), ("GE",), None, "NO", "LT", None, None),
    (("GT",), ("LT", "LE"), ("OT",), None, "GT", "NO", None, None),
    (("GT",), ("OT",), ("GT", "GE"), None, "GT", "NO", None, None),
    (("LT",), ("OT",), ("GT", "GE"), None, "NO", "LT", None, None),
    (("LE",), ("LT",), ("OT",), None, "NO", "LE", None, None),
    (("LT",), ("LT", "LE"), ("OT",), None, "NO", "LT", None, None),
    (("OT",), ("LT", "LE"), ("OT",), None, "OT", None, None, None),
    (("LE",), ("LT", "LE"), ("OT",), None, "NO", "LE", None, None),
    (("GT",), ("OT",), ("GE",), None, "GT", "NO", None, None),
    (("OT",), ("OT",), ("GE",), "GT", "GT", "NO", None, None),
    (("EQ",), ("OT",), ("GT",), None, "EQ", "EQ", None, None),
    (("GT",), ("OT",), ("GT",), None, "GE", "NO", None, None),
    (("LT",), ("OT",), ("GT",), None, "NO", "LT", None, None),
    (("OT",), ("OT",), ("GT",), None, None, "OT", None, None),
    (("OT",), ("OT",), ("EQ",), "EQ", None, None, None, None),
    (("OT", "", None), ("OT",), ("LE",), "LE", None, None, None, None),
    (("OT",), ("OT",), ("LT",), "LT", None, None, None, None),
    (("OT", "", None), ("EQ",), ("OT",), "EQ", None, None, None, None),
    (("EQ",), ("EQ",), ("EQ",), None, "NO", "LT", False, True),
    (("LT",), ("NO",), ("LT",), "EQ", "EQ", "EQ", True, True),
]

# Concept ids of the laboratory record type.
LAB_RECORD_TYPE = 44818702
