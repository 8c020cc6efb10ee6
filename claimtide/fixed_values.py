"""Values that must match the business definition exactly.

Everything in this module is data, not logic: limits, word lists and spellings
that decide which group a row falls into.
"""

from __future__ import annotations

# Per-claim limits in whole currency units, by suffix.
CAPS = {
    "a": 25_000,
    "b": 50_000,
    "c": 100_000,
    "d": 250_000,
    "e": 500_000,
    "f": 750_000,
    "g": 1_000_000,
}

# Lines of business that are reported.
REPORTED_LOBS = ["IM", "CA", "WC", "PL", "CP", "GL"]

# Class-of-business group -> reporting group.
GROUP_OF_COB_GROUP = {
    "Food & beverage": "Food & Beverage",
    "Food & beverage - deprecated": "Food & Beverage",
    "Retail": "Retail",
    "Retail - deprecated": "Retail",
    "Professional Services": "Professional Services",
    "Professional Services - deprecated": "Professional Services",
    "Day Care": "Day Care",
    "Construction": "Construction",
}

# Classes that are construction when their group decides nothing.
CONSTRUCTION_COB_NAMES = ["Tree Services", "Welding, Cutting and Metal Frame Erection"]

OTHER_GROUP = "All Other"

# Spellings of the partner channel, and the one to report.
PARTNER_SPELLINGS = ["AP Intego", "APIntego"]
PARTNER_CHANNEL = "AP Intego"

# Legal statuses.
IN_SUIT = "in suit"
ATTORNEY_STATUSES = ["attorney rep", "in suit"]

# Workers-compensation classes outside the current appetite.
WC_OUT_OF_APPETITE = [
    "Welding, Cutting and Metal Frame Erection",
    "Secretaries and Administrative Assistants, Except Legal, Medical, and Executive",
    "Masonry Work",
    "Tree Services",
    "Pool Halls",
    "Pedicabs",
    "Septic Tank System Installation, Service and Repair",
    "Building Supplies",
    "Museum Technicians and Conservators",
    "Payroll Services",
    "3D Printing",
    "Homeless Shelters",
    "Database Administrators",
    "Atmospheric and Space Scientists",
    "Correspondence Clerks",
    "Materials Scientists",
    "Shipping, Receiving, and Traffic Clerks",
    "Dispatchers, Except Police, Fire, and Ambulance",
    "Medical Transcriptionists",
    "Computer, Automated Teller, and Office Machine Repairers",
    "Brokerage Clerks",
    "Fingerprinting",
    "Anthropologists and Archeologists",
    "Donation Center",
    "Data Entry Keyers",
    "High School Teachers",
    "Rehabilitation Center",
    "Customs Brokers",
    "Court Reporters",
    "Venues and Event Spaces",
    "Elder Care Planning",
    "Pressure Washing",
    "Halfway Houses",
    "Battery Store",
    "First Line Supervisors of Personal Service Workers",
    "Geographers",
    "Wind Turbine Service Technicians",
    "Cashiers",
    "Transportation, Storage, and Distribution Managers",
    "Fitness and Exercise Equipment Store",
    "Recreation Workers",
    "Mailbox Centers",
    "Hair Loss Centers",
    "Beverage Store",
    "Geoscientists, Except Hydrologists and Geographers",
    "Inspectors, Testers, Sorters, Samplers, and Weighers",
    "Dance Clubs",
    "Virus Removal Services",
    "Statisticians",
    "Cultural Center",
    "Wills, Trusts, and Probates",
    "Elementary School Teachers",
    "Chief Executives",
    "Art Restoration",
    "Information Security Analysts",
    "Packing Services",
    "Kids Activities",
    "Process Servers",
    "Animal Shelters",
    "Siding Installation, Service and Repair",
    "Septic Tank System Cleaning",
]

# Labels.
NOT_APPLICABLE = "N/A"
BOP_LABEL, NOT_BOP_LABEL = "BOP Policy", "Not BOP Policy"
DAYS_PER_POLICY_YEAR = 365.0
