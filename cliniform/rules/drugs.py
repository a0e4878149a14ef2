"""Fixed values of the medication and vaccine rules."""

# Words that mark nutrition, supplies and placeholders.
DENIED_WORDS = [
    "undiluted diluent", "kcal/oz", "breastmilk", "kit", "item", "formula", "tpn", "custom",
    "parenteral nutrition", "breast milk", "fat emul", "human milk", "similac", "fish oil", "omega 3",
    "omega3", "omega-3", "empty bag", "unable to find", "ims template", "extemporaneous template",
    "iv infusion builder", "patient supplied medication", "misc med", "drug formulationzor",
    "water for injection",
]

# Concept classes that keep a drug in spite of a denied word.
KEPT_DRUG_CLASSES = ["Clinical Drug", "Branded Drug", "Quant Clinical Drug", "Quant Branded Drug",
                     "Clinical Pack", "Branded Pack"]

# Fixed values: (drug concepts, text fragments) whose code is replaced, in order.
CODE_OVERRIDES: list[tuple[list[int], list[str], str]] = [
    ([1367571], ["HEPARIN 1 UNIT/ML", "HEPARIN (PORCINE) 250 UNIT/250 ML (1 UNIT/ML)"], "1362025"),
    ([1367571], ["HEPARIN 2 UNIT/ML"], "1362935"),
    ([43011476], ["HEPARIN 100 UNITS/ML"], "1361048"),
    ([967823, 46276153], ["SODIUM CHLORIDE 0.9"], "313002"),
]

# Drug record types.
DISPENSED, INPATIENT_ADMIN = 38000175, 38000180
ORDERED, OUTPATIENT_ORDERED = 38000177, 581373
DOSE_FORM_TYPES = [ORDERED, INPATIENT_ADMIN, OUTPATIENT_ORDERED]
ORDER_BASIS = {ORDERED: "01", OUTPATIENT_ORDERED: "02"}
HAS_DOSE_FORM, MAPS_TO = "RxNorm has dose form", "Maps to"

# Vaccine text rules, in order.
VACCINE_TEXT: list[tuple[str, str]] = [
    ("hib (prp-t)", "48"),
    ("influenza, inj., mdck, pf, quad", "171"),
    ("influenza, recombinant, quadrivalent, pf", "185"),
    ("influenza, quadrivalent, pf, pediatrics", "185"),
    ("ppd test", "98"),
    ("td (adult),2 lf tetanus toxoid,preserv vaccine", "9"),
    ("tdap vaccine", "115"),
    ("dtap/hepb/ipv combined vaccine", "146"),
    ("hib (prp-omp)", "49"),
    ("influenza split high dose pf vaccine", "15"),
    ("mmr/varicella combined vaccined", "94"),
    ("pr pfizer sars-cov-2 vaccine", "208"),
    ("pfizer sars-cov-2 vaccination", "208"),
    ("covid-19, mrna, lnp-s, pf, 30 mcg/0.3 ml dose", "208"),
    ("pfizer covid-19", "208"),
    ("sars-cov-2 (pfizer)", "208"),
    ("moderna sars-cov-2 vaccine", "207"),
    ("moderna covid-19", "207"),
    ("sars-cov-2 (moderna)", "207"),
    ("moderna sars-cov-2 vaccination", "207"),
    ("janssen sars-cov-2 vaccine", "212"),
    ("janssen (j&j) covid-19", "212"),
    ("sars-cov-2 (janssen)", "212"),
    ("covid-19 vaccine (not specified)", "213"),
    ("sars-cov-2, unspecified", "213"),
]
VACCINE_DEFAULT = "999"

# Vaccinations that are copied into the procedures, with their procedure codes.
VACCINE_PROCEDURES = {724907: "91300", 724906: "91301", 702866: "91303"}
