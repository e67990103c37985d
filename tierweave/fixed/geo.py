"""Country tables."""

# Lower-cased spelling -> country name.
COUNTRY_NAMES = {
    "usa": "United States",
    "us": "United States",
    "united states of america": "United States",
    "uk": "United Kingdom",
    "gb": "United Kingdom",
    "great britain": "United Kingdom",
    "prc": "China",
    "cn": "China",
    "de": "Germany",
    "fr": "France",
    "jp": "Japan",
    "kr": "South Korea",
    "ca": "Canada",
    "au": "Australia",
    "il": "Israel",
    "sg": "Singapore",
    "in": "India",
    "se": "Sweden",
    "no": "Norway",
}

# Country name -> ISO code.
COUNTRY_CODES = {
    "United States": "US",
    "United Kingdom": "GB",
    "China": "CN",
    "Germany": "DE",
    "France": "FR",
    "Japan": "JP",
    "South Korea": "KR",
    "Canada": "CA",
    "Australia": "AU",
    "Israel": "IL",
    "Singapore": "SG",
    "India": "IN",
    "Sweden": "SE",
    "Norway": "NO",
}

# Country name -> tag.
COUNTRY_TAGS = {
    "China": "china",
    "United States": "us",
    "Japan": "japan",
    "South Korea": "korea",
}

# Countries tagged "europe".
EUROPE = (
    "United Kingdom", "Germany", "France", "Sweden", "Norway", "Finland", "Denmark",
    "Netherlands", "Belgium", "Switzerland", "Austria", "Italy", "Spain", "Portugal",
    "Ireland", "Poland", "Czech Republic", "Romania", "Hungary", "Estonia", "Latvia",
    "Lithuania",
)
