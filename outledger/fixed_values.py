"""Values that decide results and therefore have to be exactly these.

They are defaults for arguments, never read inside an operator. Brand lists,
warehouse codes and other values of one business come from ``rules.Rules``.
"""

# --- fixed values: delivery states of a record -------------------------------
PENDING = "Pending"
PUSHING = "Pushing"
PUSHED = "Pushed"
FAILED = "Failed"
RECORD_STATUSES = (PENDING, PUSHING, PUSHED, FAILED)
PUNCH_STATUSES = (PENDING, PUSHED, FAILED)
FINAL_STATUSES = (PUSHED, FAILED)

# --- fixed values: datasets and their titles, in board order -----------------
DATASETS = (
    ("products", "Product Master"),
    ("pricelists", "Price Lists"),
    ("images", "Product Images"),
    ("schemes", "Schemes / Promotions"),
    ("businesspartners", "Business Partners"),
    ("stockInventory", "Stock Inventory"),
    ("outstanding", "Outstanding / Receivables"),
)

# --- fixed values: records per request, by dataset ---------------------------
BATCH_SIZES = {
    "products": 1,
    "pricelists": 25,
    "images": 50,
    "schemes": 1,
    "businesspartners": 1,
    "stockInventory": 200,
    "outstanding": 200,
}

# --- fixed values: worklist paging -------------------------------------------
PAGE_DEFAULT, PAGE_MIN, PAGE_MAX = 50, 10, 200

# --- fixed values: retry policies --------------------------------------------
CRM_RETRIES, CRM_WAIT_MS = 3, 1500
HR_RETRIES, HR_WAIT_MS = 3, 2000

# --- fixed values: texts in a reply body that mean failure -------------------
ERROR_MARKS = ('"errorcode"', '"errormessage"', '"exceptionmessage"')

# --- fixed values: fields of a reply body and the JSON value that means failure
BODY_CHECKS = (
    ("success", "false"),
    ("Success", "false"),
    ("status", '"error"'),
    ("Status", '"error"'),
)

# --- fixed values: fields of an outgoing product that keep their names --------
PRODUCT_FIELDS = (
    "ShortDesc",
    "DetailedDesc",
    "CategoryName",
    "StyleCode",
    "SizeCode",
    "DivisionCode",
    "UOM",
    "AttributeSetName",
    "SizeGroup",
    "HSNCode",
    "Brand",
    "SalPackUn",
)

# --- fixed values: fields of an outgoing policy that keep their names ---------
POLICY_FIELDS = (
    "PolicyID",
    "PolicyName",
    "SavingType",
    "DiscountBasis",
    "Applicability",
    "IsCustomerDefined",
    "IsActive",
    "DivisionCode",
    "FromDate",
    "ToDate",
    "AllowDiscountForAllProducts",
    "DiscountPer",
)

# --- fixed values: outcome texts ---------------------------------------------
NOT_FOUND_TEXT = "Record not found in DB"
NOT_MAPPED_TEXT = "Mapper produced no output"
CHILD_FAILED_TEXT = "Batch failed"
ERROR_TEXT_LIMIT = 2000

# --- fixed values: tax rates rewritten on output -----------------------------
TAX_REMAP = {"12.00": "18.00"}

# --- fixed values: phone number when none of the columns holds one -----------
NO_PHONE = "9999999999"

# --- fixed values: state names by code ---------------------------------------
STATE_NAMES = {
    "AN": "Andaman and Nicobar Islands",
    "AP": "Andhra Pradesh",
    "AR": "Arunachal Pradesh",
    "AS": "Assam",
    "BR": "Bihar",
    "CH": "Chandigarh",
    "CG": "Chhattisgarh",
    "DN": "Dadra and Nagar Haveli and Daman and Diu",
    "DL": "Delhi",
    "GA": "Goa",
    "GJ": "Gujarat",
    "HR": "Haryana",
    "HP": "HimachalPradesh",
    "JK": "Jammu and Kashmir",
    "JH": "Jharkhand",
    "KA": "Karnataka",
    "KL": "Kerala",
    "LA": "Ladakh",
    "LD": "Lakshadweep",
    "MP": "Madhya Pradesh",
    "MH": "Maharashtra",
    "MN": "Manipur",
    "ML": "Meghalaya",
    "MZ": "Mizoram",
    "NL": "Nagaland",
    "OD": "Odisha",
    "OR": "Odisha",
    "PY": "Puducherry",
    "PB": "Punjab",
    "RJ": "Rajasthan",
    "SK": "Sikkim",
    "TN": "Tamil Nadu",
    "TS": "Telangana",
    "TR": "Tripura",
    "UP": "UttarPradesh",
    "UK": "Uttarakhand",
    "UT": "Uttarakhand",
    "WB": "WestBengal",
}

# --- fixed values: country names by code -------------------------------------
COUNTRY_NAMES = {
    "IN": "India",
    "US": "United States",
    "AE": "United Arab Emirates",
    "SG": "Singapore",
    "MY": "Malaysia",
    "LK": "Sri Lanka",
    "NP": "Nepal",
    "BD": "Bangladesh",
    "AU": "Australia",
    "CA": "Canada",
    "GB": "United Kingdom",
}
