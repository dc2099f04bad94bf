"""Fixed values of the data model: column names, class codes and texts that inputs and outputs must carry."""

# Model covariates in model order.
COVARIATES = [
    "StkIndx", "STInt", "dtdlevel", "dtdtrend", "liqnonfinlevel", "liqnonfintrend",
    "ni2talevel", "ni2tatrend", "sizelevel", "sizetrend", "m2b", "sigma",
    "liqfinlevel", "lqfintrend", "DTDmedianFin", "DTDmedianNonFin", "dummySOE",
]

# The 21 columns of the daily covariate input, in file order.
CUBE_COLUMNS = ["Comp_No", "YYYY", "MM", *COVARIATES, "dummyNM"]

# Covariates that are blank for non-financial firms and are set to 0.
FINANCIAL_COVARIATES = ["liqfinlevel", "lqfintrend", "DTDmedianFin"]

# Forecast horizons of the term structures, in months.
HORIZONS = [1, 2, 3, 6, 12, 24, 36, 60]

# Label codes.
NO_EVENT, DEFAULT, EXIT = 0, 1, 2
UNUSABLE_LABEL = 100
UNKNOWN_OUTCOME = -1

# Texts shown for event codes.
EVENT_TEXT = {0: "No Default", 1: "Default", 2: "Exit the Market"}
EVENT_TEXT_MISSING = "NaN"
EVENT_TEXT_OTHER = "Unknown"
DATE_TEXT_MISSING = "N/A"

# The last year of the yearly calendar spine.
SPINE_LAST_YEAR = 2030

# Training grid and fixed training parameters.
TRAINING_GRID = {
    "learning_rate": [0.01, 0.1],
    "num_leaves": [31, 64],
    "max_depth": [3, 4, 5],
    "n_estimators": [100, 200],
}

# Bounds of the random search (those that have a Spark ML counterpart).
SEARCH_SPACE = {
    "learning_rate": (0.01, 0.1),
    "max_depth": (3, 10),
    "min_child_samples": (20, 100),
    "feature_fraction": (0.5, 1.0),
    "bagging_fraction": (0.5, 1.0),
}

# The four inputs of a daily drop.
DROP_KINDS = ["covariates", "history", "pd", "poe"]
