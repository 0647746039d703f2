"""Default rule tables of the critical-care evidence map; any of them can be replaced by a caller's own."""

from __future__ import annotations

# Category rules in order of precedence, the first match wins.
CATEGORIES: list[tuple[str, list[str]]] = [
    ("Vasopressor-free days", ["vasopressor-free days"]),
    ("Vasopressor dose", ["vasopressor dose"]),
    ("Ventilation duration", ["ventilator-free days", "mechanical ventilation duration"]),
    ("Shock index", ["shock index"]),
    ("Capillary Refill", ["capillary refill", "capillary refill time"]),
    ("MAP", ["mean arterial pressure", "map"]),
    ("Blood Pressure", ["blood pressure", "systolic", "diastolic"]),
    ("Heart Rate", ["heart rate", "hr"]),
    ("Cardiac Output/Index", ["cardiac output", "cardiac index"]),
    ("Cardiac Power Output", ["cardiac power output", "cpo"]),
    ("Stroke Volume", ["stroke volume", "sv"]),
    ("SVV", ["stroke volume variation", "svv"]),
    ("PPV", ["pulse pressure variation", "ppv"]),
    ("CVP", ["central venous pressure", "cvp"]),
    ("PAP", ["pulmonary artery pressure", "pap"]),
    ("PCWP", ["pulmonary capillary wedge pressure", "pcwp"]),
    ("SVR", ["systemic vascular resistance", "systemic vascular resistance index", "svr", "svri"]),
    ("PVR", ["pulmonary vascular resistance", "pvr"]),
    ("Venous O2 Saturation", ["mixed venous oxygen saturation", "central venous oxygen saturation", "svo2", "scvo2"]),
    ("Lactate Clearance", ["lactate clearance"]),
    ("Lactate", ["lactate"]),
    ("Oxygen Delivery", ["oxygen delivery", "do2", "do2i"]),
    ("Oxygen Consumption", ["oxygen consumption", "vo2"]),
    ("Ejection Fraction", ["ejection fraction", "ef", "lvef", "rvef"]),
    ("Hemodynamics (general)", ["hemodynamic", "haemodynamic"]),
    ("Vasopressor/Inotrope", ["vasopressor", "vasoactive", "norepinephrine", "noradrenaline", "epinephrine", "adrenaline", "dopamine", "dobutamine", "phenylephrine", "vasopressin", "milrinone", "levosimendan", "inotrope", "inotropic"]),
    ("Tissue Perfusion", ["tissue perfusion", "peripheral perfusion", "perfusion index"]),
    ("Perfusion", ["perfusion"]),
    ("Fluid Responsiveness", ["passive leg raising", "fluid responsiveness", "fluid challenge", "pulse contour"]),
    ("Echocardiographic", ["tapse", "global longitudinal strain", "gls", "e/e' ratio", "lvot", "velocity time integral", "vti"]),
    ("Volumetric Hemodynamics", ["global end-diastolic volume", "gedv", "gedvi", "intrathoracic blood volume", "itbv", "itbvi", "extravascular lung water", "evlw", "evlwi"]),
    ("Tissue Oxygenation", ["tissue oxygenation", "sto2", "nirs"]),
    ("dP/dt", ["dp/dt"]),
    ("Resuscitation Endpoints", ["base deficit", "base excess", "anion gap"]),
    ("ICU Severity Score", ["apache ii", "apache", "saps ii", "saps", "qsofa", "sofa", "mods"]),
]
ADJUNCTS = ["ICU Severity Score", "Ventilation duration", "Resuscitation Endpoints", "Vasopressor-free days"]

# Keywords looked for in outcome texts.
KEYWORDS = [
    "hemodynamic", "haemodynamic", "blood pressure", "systolic", "diastolic", "mean arterial pressure", "MAP", "heart rate", "HR",
    "cardiac output", "cardiac index", "stroke volume", "SV", "stroke volume variation", "SVV", "pulse pressure variation", "PPV",
    "central venous pressure", "CVP", "pulmonary artery pressure", "PAP", "pulmonary capillary wedge pressure", "PCWP",
    "systemic vascular resistance", "SVR", "systemic vascular resistance index", "SVRI", "pulmonary vascular resistance", "PVR",
    "mixed venous oxygen saturation", "SvO2", "central venous oxygen saturation", "ScvO2", "lactate", "lactate clearance",
    "cardiac power output", "CPO", "oxygen delivery", "DO2", "DO2I", "oxygen consumption", "VO2", "capillary refill",
    "capillary refill time", "ejection fraction", "EF", "LVEF", "RVEF", "vasopressor", "vasoactive", "vasopressor-free days",
    "vasopressor dose", "inotrope", "inotropic", "norepinephrine", "noradrenaline", "epinephrine", "adrenaline", "dopamine",
    "dobutamine", "phenylephrine", "vasopressin", "milrinone", "levosimendan", "shock index", "perfusion", "tissue perfusion",
    "peripheral perfusion", "perfusion index", "ventilator-free days", "mechanical ventilation duration", "SOFA", "APACHE",
    "APACHE II", "SAPS", "SAPS II", "MODS", "qSOFA", "passive leg raising", "fluid responsiveness", "fluid challenge",
    "pulse contour", "TAPSE", "global longitudinal strain", "GLS", "E/e' ratio", "LVOT", "velocity time integral", "VTI",
    "base deficit", "base excess", "anion gap", "global end-diastolic volume", "GEDV", "GEDVI", "intrathoracic blood volume",
    "ITBV", "ITBVI", "extravascular lung water", "EVLW", "EVLWI", "dP/dt", "tissue oxygenation", "StO2", "NIRS",
]

# Contexts that veto an ambiguous token wherever they occur in the text.
VETOES = {
    "hr": (
        r"hazard\s+ratio|adjusted\s+hr\b|\bahr\b|\bchr\b|\bcshr\b|\bshr\b|\bcox\s+hr\b|sub-?distribution\s+hazard|cause-specific\s+hazard"
        r"|proportional\s+hazards?\s+.{0,80}\bhr\b|\bhr\s*[=:]\s*\d+\.\d|\bhr\s+\d+\.\d|\bhr\s*\(\s*95\s*%|\bhr\s*\[\s*95\s*%"
        r"|\bhr\s*;?\s*95\s*%\s*ci|\bhr\s+\d\.\d+\s*[,;(]"
    ),
    "sv": r"\bsv40\b",
    "pap": r"\bpap\s+(?:smear|test)\b",
    "map": r"map\s*(?:kinase|pathway)|mapk|\bmitogen[-\s]activated\s+protein",
    "ef": r"elongation\s+factor|enhancement\s+factor",
    "perfusion": r"cerebral\s+perfusion(?!\s+pressure)|myocardial\s+perfusion\s+(?:scan|imaging|study|scintigraphy|spect|pet)|perfusion\s+(?:scan|imaging|study|scintigraphy)",
    "dopamine": (
        r"dopamine\s+receptor|dopaminergic|dopamine\s+pathway|dopamine\s+d[12345]|dopamine\s+transporter"
        r"|dopamine\s+(?:agonist|antagonist)\s+(?:for|in)\s+(?:delirium|parkinson|restless)"
    ),
}

# Unit patterns (on lower-cased text) in order, and the context in which a percent sign is no unit.
UNITS: list[tuple[str, str]] = [
    (r"\bmm\s?hg\s*/\s*s\b", "mmHg/s"),
    (r"\bmm\s?hg\b", "mmHg"),
    (r"\bcm\s?h2o\b", "cmH2O"),
    (r"\bmmol\s*/\s*l\b|\bmmol per l\b", "mmol/L"),
    (r"\bmeq\s*/\s*l\b", "mEq/L"),
    (r"\bmg\s*/\s*dl\b", "mg/dL"),
    (r"\b(?:mcg|ug|µg)\s*/\s*kg\s*/\s*min\b", "mcg/kg/min"),
    (r"\bng\s*/\s*kg\s*/\s*min\b", "ng/kg/min"),
    (r"\bunits?\s*/\s*(?:hr|hour|min)\b", "units/hr"),
    (r"\bml\s*/\s*kg\s*/\s*min\b", "mL/kg/min"),
    (r"\bl\s*/\s*min\s*/\s*m2\b|\bl\s*/\s*min\s*/\s*m\^?2\b", "L/min/m2"),
    (r"\bml\s*/\s*min\s*/\s*m2\b|\bml\s*/\s*min\s*/\s*m\^?2\b", "mL/min/m2"),
    (r"\bml\s*/\s*m2\b|\bml\s*/\s*m\^?2\b", "mL/m2"),
    (r"\bl\s*/\s*min\b", "L/min"),
    (r"\bml\s*/\s*min\b", "mL/min"),
    (r"\bml\s*/\s*beat\b", "mL/beat"),
    (r"\bbeats\s*/\s*min\b|\bbeats per minute\b|\bbpm\b", "bpm"),
    (r"\bdyn(?:es)?\s*\*?\s*s\s*/\s*cm\^?5\s*/\s*m\^?2\b", "dyn*s/cm5/m2"),
    (r"\bdyn(?:es)?\s*\*?\s*s\s*/\s*cm\^?5\b", "dyn*s/cm5"),
    (r"\bwood\s+units?\b", "Wood units"),
    (r"\bwatt(?:s)?\b", "W"),
    (r"\bms\b|\bmillisec(?:onds?)?\b", "ms"),
    (r"(?<=\d\s)sec(?:onds)?(?!\w)|(?<=\d)sec(?:onds)?(?!\w)", "s"),
]
PERCENT_OF_CHANGE = r"(?:percent(?:age)?|%)\s*(?:change|reduction|increase|decrease|improvement|of\s)"

# Units of categories whose texts name none.
CATEGORY_UNITS = {
    "ICU Severity Score": "score", "Vasopressor-free days": "days", "Ventilation duration": "days", "Hemodynamics (general)": "N/A",
    "Vasopressor/Inotrope": "varies", "Perfusion": "N/A", "Tissue Perfusion": "N/A", "Fluid Responsiveness": "N/A",
    "Echocardiographic": "N/A", "Lactate Clearance": "%", "Resuscitation Endpoints": "mmol/L", "Shock index": "ratio",
    "MAP": "mmHg", "Blood Pressure": "mmHg", "Heart Rate": "bpm", "Ejection Fraction": "%", "SVV": "%", "PPV": "%",
    "Capillary Refill": "s", "Volumetric Hemodynamics": "mL/m2", "Tissue Oxygenation": "%", "dP/dt": "mmHg/s",
}

# Arm classification by words, by declared type, and the words of a placebo arm.
COMPARATORS: list[tuple[str, list[str]]] = [
    ("placebo", ["placebo"]),
    ("sham", ["sham"]),
    ("usual_care", ["usual care", "standard care", "standard of care", "routine care", "best supportive care", "guideline-based care"]),
    ("no_intervention", ["no intervention", "no treatment"]),
    ("active_control", ["active control", "active comparator"]),
    ("control", ["control arm", "control group", "comparator arm", "comparator group"]),
]
DECLARED_ARMS = {"PLACEBO_COMPARATOR": ("placebo", True), "SHAM_COMPARATOR": ("sham", True), "NO_INTERVENTION": ("no_intervention", False), "ACTIVE_COMPARATOR": ("active_control", False)}
PLACEBO_WORDS = ["placebo", "sham"]

# Identifiers of trial registries, and what is stripped from drug names.
TRIAL_ID = (
    r"^(?:NCT\d{8}|PMID:\d+|EUCTR[-\d]+|ISRCTN\d+|ACTRN\d+|ChiCTR[-\w]+|DRKS\d+|JPRN[-\w]+|CTRI/[-\w/]+|PACTR\d+|REBEC[-\w]+|KCT\d+"
    r"|IRCT[-\w]+|TCTR\d+|SLCTR/[-\w/]+|RPCEC[-\w]+|PER[-\w]+|NTR\d+|[\w]+-[\w]+-\d+)$"
)
DOSAGE = (
    r"\b\d+\s*(?:mg|mcg|µg|g|ml|iu|units?|%)\b|\b(?:tablet|capsule|injection|infusion|solution|suspension|cream|gel|patch)\b"
    r"|\b(?:oral|iv|im|sc|topical|inhaled)\b|\([^)]*\)"
)
