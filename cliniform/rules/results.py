"""Substring rules that turn a raw result text into a result code, in order.

The first pattern found in the text wins.
"""

# Pattern and code, for laboratory results and clinical observations.
RESULT_TEXT: list[tuple[str, str]] = [
    ("1+", "1+"), ("2+", "2+"), ("3+", "3+"), ("a neg", "A NEG"), ("a pos", "A POS"), ("ab negative", "AB NEG"),
    ("ab not detected", "AB NOT DETECTED"), ("ab positive", "AB POS"), ("abbnormal", "ABNORMAL"), ("abnormal", "ABNORMAL"),
    ("absent", "ABSENT"), ("acanthocytes", "ACANTHOCYTES"), ("adequate", "ADEQUATE"), ("amber", "AMBER"),
    ("amniotic fluid", "AMNIOTIC FLUID"), ("anisocytosis", "ANISOCYTOSIS"), ("arterial", "ARTERIAL"),
    ("arterial line", "ARTERIAL LINE"), ("b neg", "B NEG"), ("b pos", "B POS"), ("basophilic stippling", "BASOPHILIC STIPPLING"),
    ("bite cells", "BITE CELLS"), ("bizarre", "BIZARRE CELLS"), ("black", "BLACK"), ("blister cells", "BLISTER CELLS"),
    ("blood", "BLOOD"), ("bone marrow", "BONE MARROW"), ("brown", "BROWN"), ("burr cells", "BURR CELLS"),
    ("cerebrospinal fluid", "CEREBROSPINAL FLUID (CSF)"), ("clean catch", "CLEAN CATCH"), ("Clear", "CLEAR"), ("CLEAR", "CLEAR"),
    ("clear", "CLEAR"), ("cloudy", "CLOUDY"), ("colorless", "COLORLESS"), ("dacrocytes", "DACROCYTES"), ("detected", "DETECTED"),
    ("elliptocytes", "ELLIPTOCYTES"), ("equivocal", "EQUIVOCAL"), ("few", "FEW"), ("green", "GREEN"), ("hair", "HAIR"),
    ("hazy", "HAZY"), ("helmet", "HELMET CELLS"), ("heterozygous", "HETEROZYGOUS"), ("howelljolly", "HOWELL-JOLLY BODIES"),
    ("howell jolly", "HOWELL-JOLLY BODIES"), ("howell-jolly", "HOWELL-JOLLY BODIES"), ("immune", "IMMUNE"),
    ("Inconclusive", "INCONCLUSIVE"), ("increased", "INCREASED"), ("indeterminate", "INDETERMINATE"),
    ("influenza A virus", "INFLUENZA A VIRUS"), ("influenza B virus", "INFLUENZA B VIRUS"), ("invalid", "INVALID"),
    ("large", "LARGE"), ("left arm", "LEFT ARM"), ("low", "LOW"), ("macrocytes", "MACROCYTES"), ("many", "MANY"),
    ("microcytes", "MICROCYTES"), ("moderate", "MODERATE"), ("nasopharyngeal", "NASOPHARYNGEAL"), ("neg", "NEGATIVE"),
    ("tnp", "NI"), ("no growth", "NO GROWTH"), ("none", "NONE"), ("nonreactive", "NONREACTIVE"), ("normal", "NORMAL"),
    ("none detected.", "NOT DETECTED"), ("not detected", "NOT DETECTED"), ("o negative", "O NEG"), ("o positive", "O POS"),
    ("occasional", "OCCASIONAL"), ("@", "OT"), ("see Comment", "OT"), ("ovalocytes", "OVALOCYTES"),
    ("pappenheimer bodies", "PAPPENHEIMER BODIES"), ("peritoneal fluid", "PERITONEAL FLUID"), ("pink", "PINK"),
    ("plasma", "PLASMA"), ("pos", "POSITIVE"), ("rare", "RARE"), ("reactive", "REACTIVE"), ("right arm", "RIGHT ARM"),
    ("sars coronavirus 2", "SARS CORONAVIRUS 2"), ("slight", "SLIGHT"), ("Slightly Cloudy", "SLIGHTLY CLOUDY"),
    ("small", "SMALL"), ("Specimen unsatisfactory for evaluation", "SPECIMEN UNSATISFACTORY FOR EVALUATION"),
    ("stomatocytes", "STOMATOCYTES"), ("stool", "STOOL"), ("straw", "STRAW"), ("suspect", "SUSPECTED"),
    ("synovial fluid", "SYNOVIAL FLUID"), ("trace", "TRACE"), ("turbid", "TURBID"), ("unknown", "UN"),
    ("undetected", "UNDETECTABLE"), ("inconclusive", "UNDETERMINED"), ("urine", "URINE"), ("white", "WHITE"),
    ("yellow", "YELLOW"),
]

# Pattern and code, for general observations.
GENERAL_RESULT_TEXT: list[tuple[str, str]] = [
    ("1+", "1+"), ("2+", "2+"), ("3+", "3+"), ("a neg", "A NEG"), ("a pos", "A POS"), ("ab negative", "AB NEG"),
    ("ab not detected", "AB NOT DETECTED"), ("ab positive", "AB POS"), ("abbnormal", "ABNORMAL"), ("abnormal", "ABNORMAL"),
    ("absent", "ABSENT"), ("acanthocytes", "ACANTHOCYTES"), ("adequate", "ADEQUATE"), ("amber", "AMBER"),
    ("amniotic fluid", "AMNIOTIC FLUID"), ("anisocytosis", "ANISOCYTOSIS"), ("arterial", "ARTERIAL"),
    ("arterial line", "ARTERIAL LINE"), ("b neg", "B NEG"), ("b pos", "B POS"), ("basophilic stippling", "BASOPHILIC STIPPLING"),
    ("bite cells", "BITE CELLS"), ("bizarre", "BIZARRE CELLS"), ("black", "BLACK"), ("blister cells", "BLISTER CELLS"),
    ("blood", "BLOOD"), ("bone marrow", "BONE MARROW"), ("brown", "BROWN"), ("burr cells", "BURR CELLS"),
    ("cerebrospinal fluid", "CEREBROSPINAL FLUID (CSF)"), ("clean catch", "CLEAN CATCH"), ("clear", "CLEAR"),
    ("cloudy", "CLOUDY"), ("colorless", "COLORLESS"), ("dacrocytes", "DACROCYTES"), ("detected", "DETECTED"),
    ("elliptocytes", "ELLIPTOCYTES"), ("equivocal", "EQUIVOCAL"), ("few", "FEW"), ("green", "GREEN"), ("hair", "HAIR"),
    ("hazy", "HAZY"), ("helmet", "HELMET CELLS"), ("heterozygous", "HETEROZYGOUS"), ("howelljolly", "HOWELL-JOLLY BODIES"),
    ("howell jolly", "HOWELL-JOLLY BODIES"), ("howell-jolly", "HOWELL-JOLLY BODIES"), ("immune", "IMMUNE"),
    ("inconclusive", "INCONCLUSIVE"), ("increased", "INCREASED"), ("indeterminate", "INDETERMINATE"),
    ("influenza A virus", "INFLUENZA A VIRUS"), ("influenza B virus", "INFLUENZA B VIRUS"), ("invalid", "INVALID"),
    ("large", "LARGE"), ("left arm", "LEFT ARM"), ("low", "LOW"), ("macrocytes", "MACROCYTES"), ("many", "MANY"),
    ("microcytes", "MICROCYTES"), ("moderate", "MODERATE"), ("nasopharyngeal", "NASOPHARYNGEAL"), ("neg", "NEGATIVE"),
    ("tnp", "NI"), ("no growth", "NO GROWTH"), ("none", "NONE"), ("nonreactive", "NONREACTIVE"), ("normal", "NORMAL"),
    ("none detected.", "NOT DETECTED"), ("not detected", "NOT DETECTED"), ("o negative", "O NEG"), ("o positive", "O POS"),
    ("occasional", "OCCASIONAL"), ("@", "OT"), ("see Comment", "OT"), ("ovalocytes", "OVALOCYTES"),
    ("pappenheimer bodies", "PAPPENHEIMER BODIES"), ("peritoneal fluid", "PERITONEAL FLUID"), ("pink", "PINK"),
    ("plasma", "PLASMA"), ("pos", "POSITIVE"), ("rare", "RARE"), ("reactive", "REACTIVE"), ("right arm", "RIGHT ARM"),
    ("sars coronavirus 2", "SARS CORONAVIRUS 2"), ("slight", "SLIGHT"), ("slightly Cloudy", "SLIGHTLY CLOUDY"),
    ("small", "SMALL"), ("specimen unsatisfactory for evaluation", "SPECIMEN UNSATISFACTORY FOR EVALUATION"),
    ("stomatocytes", "STOMATOCYTES"), ("stool", "STOOL"), ("straw", "STRAW"), ("suspect", "SUSPECTED"),
    ("synovial fluid", "SYNOVIAL FLUID"), ("trace", "TRACE"), ("turbid", "TURBID"), ("unknown", "UN"),
    ("undetected", "UNDETECTABLE"), ("inconclusive", "UNDETERMINED"), ("urine", "URINE"), ("white", "WHITE"),
    ("yellow", "YELLOW"),
]
