"""Fixed values of the person, visit, diagnosis and survey rules."""

from datetime import date

# Observed answers and their codes.
ORIENTATION_QUESTION, IDENTITY_QUESTION = 46235214, 46235215
ORIENTATION = {36307527: "BI", 36303203: "HO", 36310681: "ST", 36308454: "DC", 45878142: "OT", 45877986: "UN"}
IDENTITY = {36308665: "M", 36307702: "F", 36309198: "TM", 36309787: "TF", 36309864: "GQ", 1585351: "GQ",
            36308454: "DC", 45878142: "OT"}

# Visit rules.
DISPOSITION_QUESTION = 44813951
ALIVE, EXPIRED = 4161979, 4216643
GROUP_QUESTION = 3040464
GROUPS_SINCE = date(2007, 10, 1)
PRIMARY_PAYER, SECONDARY_PAYER = 31968, 31969
VISITS_WITHOUT_DISCHARGE = [9202, 44814711, 2000000469, 581399]

# Diagnosis and condition rules.
PROBLEM_LIST_TYPES = [2000000089, 2000000090, 2000000091, 38000245]
COMPLAINT_TYPES = [2000001423, 2000001424, 2000001425]
PRIMARY_NAMED_TYPES = [2000000092, 2000000093, 2000000094, 2000000098, 2000000099, 2000000100, 38000201, 38000230]
COMPLAINT_QUESTION = 42894222
DERIVED_QUESTION = 2000001411
DERIVED_ANSWERS = [2000001411, 2000001412, 2000001413]
NO_DIAGNOSIS_MARK = "NOD.X"
UNCODED_SOURCE = 44814649
ICD9, ICD10 = "ICD9CM", ["ICD10", "ICD10CM"]
ICD_VOCABULARIES = [ICD9, *ICD10]
EPIDEMIC_FRAGMENTS = ["B97.28", "U07.1", "B34.2", "B34.9", "B97.2", "B97.21", "J12.81", "U04", "U04.9", "U07.2",
                      "Z20.828"]
FLIPPED_VISITS, FLIPPED_ORIGIN, PRIMARY = ["IP", "EI"], "OD", "P"

# Procedure rules.
PROCEDURE_VOCABULARIES = ["HCPCS", "CPT4", "ICD10PCS", "ICD9Proc"]
EXCLUDED_PROCEDURE_CLASSES = ["CPT4 Modifier", "2-dig nonbill code"]

# Death rules.
DEATH_RECORD_TYPE = 38003569
UNKNOWN_CAUSE = 44814650
ICD10_SINCE = date(2015, 10, 1)
IGNORED_CAUSES = ["NI", "0", "Z1001"]
FOREIGN_CAUSE_MARK = "IMO"

# Survey items.
SURVEY_ITEMS = [3042924, 3045858, 3045933, 3044964, 3044098, 3043801, 3045019, 3043785, 3043462]
SURVEY_SCORES = [3042932, 40758879]
# only the first answer of a repeated id can ever match, so 2 and 3 are never given
SURVEY_ANSWERS = [(45883172, 0), (45879886, 1), (45883172, 2), (45883172, 3)]
HUNGER_RUN_OUT, HUNGER_NOT_LAST, HUNGER_FLAG = 40192517, 40192426, 37116643
HUNGER_ITEM_CODES = {HUNGER_RUN_OUT: "88122-7", HUNGER_NOT_LAST: "88123-5"}
HUNGER_ITEM_NAMES = {
    HUNGER_RUN_OUT: "Within the past 12 months we worried whether our food would run out before we got money "
                    "to buy more [U.S. Food Security Survey]",
    HUNGER_NOT_LAST: "Within the past 12 months the food we bought just didn't last and we didn't have money "
                     "to get more [U.S. Food Security Survey]",
}
HUNGER_FLAG_CODE, HUNGER_FLAG_NAME = "88124-3", "Food insecurity risk (Hunger Vital Sign)"
YES, NO, NO_INFORMATION = 4188539, 4188540, 44814653
YES_TEXTS = ["Often true", "Sometimes true", "Yes", "YES"]
NO_TEXTS = ["Never true", "No", "NO"]
SURVEY_QUESTIONS = [*SURVEY_ITEMS, *SURVEY_SCORES, HUNGER_RUN_OUT, HUNGER_NOT_LAST, HUNGER_FLAG]

# Vital signs. Only one height and one weight concept is read into columns.
HEIGHT, OTHER_HEIGHT, WEIGHT, OTHER_WEIGHT, BODY_MASS = 3023540, 3036277, 3013762, 3025315, 3038553
SYSTOLIC = [3018586, 3035856, 3009395, 3004249]
DIASTOLIC = [3034703, 3019962, 3013940, 3012888]
VITAL_CONCEPTS = [HEIGHT, OTHER_HEIGHT, WEIGHT, OTHER_WEIGHT, BODY_MASS, *SYSTOLIC, *DIASTOLIC]
TOBACCO, TOBACCO_TYPE, SMOKING = 4005823, 4219336, 4275495
MEASUREMENT_DOMAIN = 21

# Clinical observations.
CLINICAL_CONCEPTS = [3020891, 3024171, 40762499, 3027018, 4353936, 21490852, 21492241, 3020158, 3037879, 3001668,
                     3024653, 3005025, 3023550, 42868460, 42868461, 42868462, 3023329]
OXYGEN_CONCEPT, OXYGEN_CODE = 4353936, "250774007"
VAPING_QUESTION, VAPING_ANSWERS = 4219336, [42536422, 42536421, 36716478]
GESTATION_CODE = "18185-9"

# General observations.
ICU_SERVICES = [2000000079, 2000000080, 2000000078]
EPIDEMIC_RESULT, GENERAL_MEASUREMENTS = 2000001422, [2000001422, 4353936]
DEVICE_CONCEPTS = [4044008, 4097216, 4138614, 45761494, 4224038, 4139525, 45768222, 4222966, 40493026]
GENERAL_TYPE, ICU_CODE, RESULT_CODE, DEVICE_CODE, CENSUS_CODE = "PC_COVID", "2000", "1000", "3000", "49084-7"
