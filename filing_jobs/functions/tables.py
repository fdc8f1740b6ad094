"""Names, types, abbreviations. They define results and are stated as they are."""

# Fixed values. Titles of forms and schedules.
FORM_TITLES = {
    "IRS990": "Form 990 (Full)",
    "IRS990EZ": "Form 990-EZ (Short)",
    "IRS990PF": "Form 990-PF (Private Foundation)",
    "IRS990T": "Form 990-T (Exempt Organization Business Income Tax)",
    "IRS990TScheduleA": "Form 990-T Schedule A (Unrelated Business Taxable Income)",
    "IRS990ScheduleA": "Schedule A – Public Charity Status and Public Support",
    "IRS990ScheduleB": "Schedule B – Contributors (Restricted)",
    "IRS990ScheduleC": "Schedule C – Political Campaign and Lobbying Activities",
    "IRS990ScheduleD": "Schedule D – Supplemental Financial Statements",
    "IRS990ScheduleE": "Schedule E – Schools",
    "IRS990ScheduleF": "Schedule F – Activities Outside the United States",
    "IRS990ScheduleG": "Schedule G – Fundraising and Gaming Activities",
    "IRS990ScheduleH": "Schedule H – Hospitals",
    "IRS990ScheduleI": "Schedule I – Grants and Other Assistance (Domestic)",
    "IRS990ScheduleJ": "Schedule J – Compensation Information",
    "IRS990ScheduleK": "Schedule K – Tax-Exempt Bonds",
    "IRS990ScheduleL": "Schedule L – Transactions with Interested Persons",
    "IRS990ScheduleM": "Schedule M – Noncash Contributions",
    "IRS990ScheduleN": "Schedule N – Liquidation, Termination, Dissolution, or Significant Disposition of Assets",
    "IRS990ScheduleO": "Schedule O – Supplemental Information",
    "IRS990ScheduleR": "Schedule R – Related Organizations and Unrelated Partnerships",
    "ReturnHeader": "Return Header (Filing Metadata)",
    "IRS4562": "Form 4562 – Depreciation and Amortization",
    "IRS4136": "Form 4136 – Credit for Federal Tax Paid on Fuels",
    "IRS3800": "Form 3800 – General Business Credit",
    "IRS8949": "Form 8949 – Sales and Dispositions of Capital Assets",
    "IRS1041ScheduleD": "Form 1041 Schedule D – Capital Gains and Losses",
    "IRS1041ScheduleI": "Form 1041 Schedule I – Alternative Minimum Tax",
    "IRS1120ScheduleD": "Form 1120 Schedule D – Capital Gains and Losses",
    "ExpenditureResponsibilityStmt": "Expenditure Responsibility Statement",
    "TransfersToControlledEntities": "Transfers to Controlled Entities Schedule",
    "TransfersFrmControlledEntities": "Transfers from Controlled Entities Schedule",
    "LoansFromOfficersSchedule": "Loans from Officers Schedule",
    "MortgagesAndNotesPayableSch": "Mortgages and Notes Payable Schedule",
    "OtherNotesLoansRcvblLongSch": "Other Notes/Loans Receivable (Long) Schedule",
    "AffiliateListing": "Affiliate Listing",
    "CompensationExplanation": "Compensation Explanation",
    "ContractorCompensationExpln": "Contractor Compensation Explanation",
    "AmortizationSchedule": "Amortization Schedule",
    "GainLossSaleOtherAssetsSch": "Gain/Loss from Sale of Other Assets Schedule",
    "AccountingFeesSchedule": "Accounting Fees Schedule",
    "TaxesSchedule": "Taxes Schedule",
    "OtherExpensesSchedule": "Other Expenses Schedule",
    "InvestmentsCorpStockSchedule": "Investments – Corporate Stock Schedule",
    "InvestmentsOtherSchedule2": "Investments – Other Schedule",
    "OtherIncreasesSchedule": "Other Increases Schedule",
    "OtherDecreasesSchedule": "Other Decreases Schedule",
    "LegalFeesSchedule": "Legal Fees Schedule",
    "DepreciationSchedule": "Depreciation Schedule",
    "OtherAssetsSchedule": "Other Assets Schedule",
    "OtherLiabilitiesSchedule": "Other Liabilities Schedule",
    "ActyNotPreviouslyRptExpln": "Activities Not Previously Reported Explanation",
}

# Fixed values. Descriptions of schema types.
TYPE_NAMES = {
    "BooleanType": "Yes/No",
    "CheckboxType": "Checkbox (X if checked)",
    "USAmountType": "Dollar amount (USD)",
    "USAmountNNType": "Dollar amount, non-negative (USD)",
    "IntegerType": "Whole number",
    "IntegerNNType": "Whole number, non-negative",
    "LargeRatioType": "Ratio / percentage",
    "RatioType": "Ratio / percentage",
    "DecimalType": "Decimal number",
    "LineExplanationType": "Free-text explanation",
    "ExplanationType": "Free-text explanation",
    "ShortExplanationType": "Short free-text explanation",
    "ShortDescriptionType": "Short description",
    "PersonNameType": "Person name",
    "BusinessNameType": "Organization name",
    "BusinessNameLine1Type": "Organization name (line 1)",
    "BusinessNameLine2Type": "Organization name (line 2)",
    "BusinessNameLine1Txt": "Organization name (line 1)",
    "EINType": "Employer Identification Number",
    "SSNType": "Social Security Number",
    "YearType": "Four-digit year",
    "DateType": "Date",
    "TimestampType": "Date and time",
    "PhoneNumberType": "Phone number",
    "ZIPCodeType": "ZIP code",
    "StateType": "US state abbreviation",
    "CountryType": "Country code",
    "StringType": "Text",
    "StreetAddressType": "Street address",
    "CityType": "City name",
    "CountType": "Count (whole number)",
}

# Fixed values. Replacements in labels, in this order.
LABEL_WORDS = [
    ("Amt", "Amount"), ("Ind", "Indicator"), ("Cnt", "Count"), ("Dt", "Date"), ("Txt", "Text"), ("Nm", "Name"), ("Cd", "Code"),
    ("Grp", "Group"), ("Prsn", "Person"), ("Org", "Organization"), ("Cmpnstn", "Compensation"), ("Rltd", "Related"),
    ("Offcr", "Officer"), ("Trst", "Trust"), ("Empl", "Employee"), ("Fndrsng", "Fundraising"), ("Rvn", "Revenue"),
    ("Expns", "Expense"), ("Bsnss", "Business"), ("Strt", "Street"), ("Addrss", "Address"), ("Ttl", "Total"),
    ("Prtcl", "Protocol"), ("Dfrrd", "Deferred"), ("Nntxbl", "Nontaxable"), ("Bnfts", "Benefits"), ("Flng", "Filing"),
    ("Orgnztn", "Organization"), ("Cntrbtn", "Contribution"), ("Prgrm", "Program"), ("Srvcs", "Services"),
    ("Gvrnng", "Governing"), ("Mmbr", "Member"), ("Schdl", "Schedule"), ("Intrstd", "Interested"), ("Prty", "Party"),
    ("Trnsctn", "Transaction"),
]

# Fixed values. Words of element names and what they stand for when names are compared.
NAME_WORDS = {
    "amt": "amount", "grp": "group", "ind": "indicator", "cnt": "count", "rt": "rate", "txt": "text", "cd": "code", "dt": "date",
    "nm": "name", "yr": "year", "num": "number", "org": "organization", "orgn": "organization", "nztn": "organization",
    "nzn": "organization", "cmpnstn": "compensation", "cmpnst": "compensation", "rltd": "related", "offcr": "officer",
    "trst": "trust", "empl": "employee", "cmps": "compensation", "flng": "filing", "bs": "base", "bns": "bonus",
    "dfrd": "deferred", "svrnc": "severance", "prsn": "person", "addr": "address", "desc": "description", "frgn": "foreign",
    "rpt": "report", "rptbl": "reportable", "cntrbtn": "contribution", "cntrbtns": "contributions", "grnts": "grants",
    "grnt": "grant", "fndrsng": "fundraising", "invst": "investment", "pblc": "public", "sprt": "support", "ttl": "total",
    "rvn": "revenue", "rvns": "revenues", "expns": "expenses", "expnss": "expenses", "bnft": "benefit", "bnfts": "benefits",
    "schdl": "schedule", "pymnt": "payment", "dsqlfyng": "disqualifying", "xcs": "excess", "dsrgrd": "disregarded",
    "prtnr": "partner", "shr": "share", "shrhld": "shareholder", "id": "identification", "eoy": "endofyear",
    "boy": "beginningofyear", "cy": "currentyear", "py": "prioryear",
}

# Fixed values. Element names and what older filings call them.
OLDER_NAMES = {
    "AddressLine1Txt": "AddressLine1",
    "AddressLine2Txt": "AddressLine2",
    "CityNm": "City",
    "StateAbbreviationCd": "State",
    "ZIPCd": "ZIPCode",
    "BusinessNameLine1Txt": "BusinessNameLine1",
    "BusinessNameLine2Txt": "BusinessNameLine2",
}
