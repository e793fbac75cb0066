"""Declared constraints of the data model, as data for the audit jobs.

Fixed values: keys, references, row conditions and defaults of the model. Row conditions are Spark
SQL predicates; NULL counts as passed.
"""

from __future__ import annotations

from dataclasses import dataclass

from tidewake.schema import TABLES, struct_of


@dataclass(frozen=True)
class Unique:
    name: str
    table: str
    columns: tuple[str, ...]
    primary: bool = False


@dataclass(frozen=True)
class Reference:
    name: str
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class RowCheck:
    name: str
    table: str
    condition: str


def primary_keys(tables: list[str] | None = None) -> list[Unique]:
    """The first declared column of every table is its key."""
    return [Unique(f"PK_{t}", t, (key_of(t),), primary=True) for t in (tables or TABLES)]


def key_of(table: str) -> str:
    return TABLES[table].split()[0]


# table, columns that are unique together
_UNIQUE = [
    ("CruiseOperator", ("OperatorName",)),
    ("CruiseShip", ("OperatorID", "ShipName")),
    ("CabinCategory", ("CategoryName",)),
    ("Cabin", ("ShipID", "CabinNumber")),
    ("CabinAdjacency", ("CabinID", "AdjacentCabinID")),
    ("Port", ("PortName", "Country")),
    ("RoutePort", ("RouteID", "StopSequence")),
    ("Passenger", ("PassportNo",)),
    ("AgeCategory", ("CategoryName",)),
    ("BookingCabin", ("BookingID", "CabinID")),
    ("FareRule", ("VoyageID", "CabinCategoryID", "AgeCategoryID", "EffectiveFrom")),
    ("BookingPassenger", ("BookingID", "PassengerID")),
    ("DiningOption", ("DiningName",)),
    ("ShipDiningOption", ("ShipID", "DiningOptionID")),
    ("SpecialtyDiningType", ("TypeName",)),
    ("ShipSpecialtyDining", ("ShipID", "SpecialtyDiningTypeID")),
    ("VoyageMealPackageType", ("PackageName",)),
    ("VoyageMealPackageRule", ("MinVoyageLengthDays", "MaxVoyageLengthDays")),
    ("VoyageMealPackage", ("VoyageID",)),
    ("SpecialService", ("ServiceName",)),
    ("PassengerSpecialService", ("BookingPassengerID", "ServiceID")),
    ("Excursion", ("PortID", "ExcursionName")),
    ("VoyageExcursion", ("VoyageID", "RoutePortID", "ExcursionID")),
    ("BookingExcursion", ("BookingPassengerID", "VoyageExcursionID")),
    ("BookingCancellation", ("BookingID",)),
    ("Payment", ("TransactionReference",)),
]
UNIQUES = [Unique(f"UQ_{table}_{'_'.join(columns)}", table, columns) for table, columns in _UNIQUE]

# child table, column, parent table; the parent column is the key of the parent
_REFERENCES = [
    ("CruiseShip", "OperatorID", "CruiseOperator"),
    ("Cabin", "ShipID", "CruiseShip"),
    ("Cabin", "CabinCategoryID", "CabinCategory"),
    ("CabinAdjacency", "CabinID", "Cabin"),
    ("CabinAdjacency", "AdjacentCabinID", "Cabin"),
    ("RoutePort", "RouteID", "CruiseRoute"),
    ("RoutePort", "PortID", "Port"),
    ("CruiseVoyage", "ShipID", "CruiseShip"),
    ("CruiseVoyage", "RouteID", "CruiseRoute"),
    ("Booking", "CustomerPassengerID", "Passenger"),
    ("Booking", "VoyageID", "CruiseVoyage"),
    ("Booking", "OriginalBookingID", "Booking"),
    ("BookingCabin", "BookingID", "Booking"),
    ("BookingCabin", "CabinID", "Cabin"),
    ("FareRule", "VoyageID", "CruiseVoyage"),
    ("FareRule", "CabinCategoryID", "CabinCategory"),
    ("FareRule", "AgeCategoryID", "AgeCategory"),
    ("BookingPassenger", "BookingID", "Booking"),
    ("BookingPassenger", "BookingCabinID", "BookingCabin"),
    ("BookingPassenger", "PassengerID", "Passenger"),
    ("BookingPassenger", "AgeCategoryID", "AgeCategory"),
    ("BookingPassenger", "FareRuleID", "FareRule"),
    ("ShipDiningOption", "ShipID", "CruiseShip"),
    ("ShipDiningOption", "DiningOptionID", "DiningOption"),
    ("ShipSpecialtyDining", "ShipID", "CruiseShip"),
    ("ShipSpecialtyDining", "SpecialtyDiningTypeID", "SpecialtyDiningType"),
    ("VoyageMealPackageRule", "MealPackageTypeID", "VoyageMealPackageType"),
    ("VoyageMealPackage", "VoyageID", "CruiseVoyage"),
    ("VoyageMealPackage", "MealPackageRuleID", "VoyageMealPackageRule"),
    ("PassengerSpecialService", "BookingPassengerID", "BookingPassenger"),
    ("PassengerSpecialService", "ServiceID", "SpecialService"),
    ("BaggageRule", "OperatorID", "CruiseOperator"),
    ("BookingBaggage", "BookingPassengerID", "BookingPassenger"),
    ("Excursion", "PortID", "Port"),
    ("VoyageExcursion", "VoyageID", "CruiseVoyage"),
    ("VoyageExcursion", "RoutePortID", "RoutePort"),
    ("VoyageExcursion", "ExcursionID", "Excursion"),
    ("BookingExcursion", "BookingPassengerID", "BookingPassenger"),
    ("BookingExcursion", "VoyageExcursionID", "VoyageExcursion"),
    ("CancellationPolicy", "OperatorID", "CruiseOperator"),
    ("BookingCancellation", "BookingID", "Booking"),
    ("RescheduleRequest", "OriginalBookingID", "Booking"),
    ("RescheduleRequest", "NewBookingID", "Booking"),
    ("RescheduleRequest", "NewVoyageID", "CruiseVoyage"),
    ("Payment", "BookingID", "Booking"),
]
REFERENCES = [
    Reference(f"FK_{table}_{column}", table, column, parent, key_of(parent)) for table, column, parent in _REFERENCES
]

# Conditions that the tables declare.
_DECLARED = {
    "Cabin": {"MaxOccupancy": "MaxOccupancy BETWEEN 1 AND 5"},
    "CabinAdjacency": {"NotSelf": "CabinID <> AdjacentCabinID"},
    "CruiseVoyage": {"ArrivalAfterDeparture": "ArrivalDateTime > DepartureDateTime"},
    "AgeCategory": {"AgeRange": "MinAge >= 0 AND (MaxAge IS NULL OR MaxAge >= MinAge)"},
    "Booking": {
        "Status": "BookingStatus IN ('Pending', 'Confirmed', 'Waitlisted', 'Cancelled', 'Rescheduled', 'Completed')"
    },
    "BookingPassenger": {"InfantBedOption": "InfantBedOption IN ('SharedBed', 'Cot', 'NotApplicable')"},
    "CancellationPolicy": {"PenaltyType": "PenaltyType IN ('Percentage', 'FixedAmount', 'FullForfeit')"},
}
# Conditions that only the documentation states.
_DOCUMENTED = {
    "CruiseShip": {"TotalDecks": "TotalDecks > 0", "PassengerCapacity": "PassengerCapacity > 0"},
    "CabinCategory": {"CategoryName": "CategoryName IN ('Interior', 'Ocean View', 'Balcony', 'Suite')"},
    "Cabin": {"DeckNumber": "DeckNumber > 0"},
    "CabinAdjacency": {"Type": "AdjacencyType IN ('Adjacent', 'Connecting')"},
    "CruiseRoute": {"RouteType": "RouteType IN ('One-way', 'Round-trip', 'Multi-destination')"},
    "CruiseVoyage": {
        "BaggageLimit": "BaggageWeightLimitKG > 0",
        "Status": "VoyageStatus IN ('Scheduled', 'Boarding', 'Departed', 'Completed', 'Cancelled')",
    },
    "BookingCabin": {"CabinPrice": "CabinPrice >= 0"},
    "FareRule": {
        "BaseFare": "BaseFare >= 0",
        "EffectiveDate": "EffectiveTo IS NULL OR EffectiveTo >= EffectiveFrom",
    },
    "SpecialService": {
        "ServiceType": "ServiceType IN ('Childcare', 'Teen Club', 'Accessibility', 'Mobility', 'Chaperoned Youth')",
        "AgeRestriction": "(AgeRestrictionMin IS NULL AND AgeRestrictionMax IS NULL) OR (AgeRestrictionMin IS NOT NULL "
        "AND AgeRestrictionMax IS NOT NULL AND AgeRestrictionMax >= AgeRestrictionMin)",
        "Fee": "Fee >= 0",
    },
    "CancellationPolicy": {"Hours": "HoursBeforeDeparture >= 0", "PenaltyValue": "PenaltyValue >= 0"},
    "BookingCancellation": {"Amounts": "PenaltyAmount >= 0 AND RefundAmount >= 0"},
    "Payment": {
        "Amount": "Amount > 0",
        "Status": "PaymentStatus IN ('Pending', 'Paid', 'Failed', 'Refunded', 'Partially Refunded')",
    },
}


def _checks(source: dict[str, dict[str, str]]) -> list[RowCheck]:
    return [
        RowCheck(f"CK_{table}_{label}", table, condition)
        for table, conditions in source.items()
        for label, condition in conditions.items()
    ]


DECLARED_CHECKS = _checks(_DECLARED)
DOCUMENTED_CHECKS = _checks(_DOCUMENTED)

# Declared widths of the text columns: table, column, width.
_WIDTHS = [
    ("CruiseOperator", "OperatorName", 150),
    ("CruiseOperator", "HeadquartersCountry", 100),
    ("CruiseOperator", "ContactEmail", 150),
    ("CruiseShip", "ShipName", 150),
    ("CabinCategory", "CategoryName", 50),
    ("CabinCategory", "CategoryDescription", 255),
    ("Cabin", "CabinNumber", 20),
    ("CabinAdjacency", "AdjacencyType", 20),
    ("CruiseRoute", "RouteName", 150),
    ("CruiseRoute", "RouteType", 30),
    ("Port", "PortName", 150),
    ("Port", "Country", 100),
    ("CruiseVoyage", "VoyageStatus", 30),
    ("Passenger", "FullName", 150),
    ("Passenger", "PassportNo", 50),
    ("Passenger", "Nationality", 100),
    ("Passenger", "Gender", 20),
    ("Passenger", "ContactNo", 30),
    ("Passenger", "Email", 150),
    ("AgeCategory", "CategoryName", 30),
    ("Booking", "BookingStatus", 30),
    ("BookingPassenger", "InfantBedOption", 20),
    ("DiningOption", "DiningName", 100),
    ("SpecialtyDiningType", "TypeName", 100),
    ("SpecialtyDiningType", "Description", 255),
    ("VoyageMealPackageType", "PackageName", 100),
    ("SpecialService", "ServiceName", 100),
    ("SpecialService", "ServiceType", 50),
    ("PassengerSpecialService", "RequestStatus", 30),
    ("Excursion", "ExcursionName", 150),
    ("Excursion", "Description", 500),
    ("BookingExcursion", "ExcursionStatus", 30),
    ("CancellationPolicy", "PenaltyType", 30),
    ("BookingCancellation", "Reason", 255),
    ("BookingCancellation", "ProcessedBy", 100),
    ("RescheduleRequest", "RequestStatus", 30),
    ("RescheduleRequest", "Reason", 255),
    ("Payment", "PaymentMethod", 50),
    ("Payment", "PaymentStatus", 30),
    ("Payment", "TransactionReference", 100),
]


def width_checks() -> list[RowCheck]:
    return [RowCheck(f"LEN_{table}_{column}", table, f"char_length({column}) <= {width}") for table, column, width in _WIDTHS]


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in struct_of(table).fields if not f.nullable]


# Defaults; "now" stands for the as-of moment the caller passes.
DEFAULTS: dict[str, dict[str, str]] = {
    "CruiseOperator": {"AllowsChaperonedYouth": "false"},
    "Cabin": {"IsWheelchairAccessible": "false"},
    "CabinAdjacency": {"AdjacencyType": "Adjacent"},
    "RoutePort": {"IsHomePort": "false"},
    "CruiseVoyage": {"VoyageStatus": "Scheduled"},
    "Booking": {"BookingDate": "now", "BookingStatus": "Confirmed", "TotalAmount": "0"},
    "BookingCabin": {"CabinPrice": "0"},
    "BookingPassenger": {
        "InfantBedOption": "NotApplicable",
        "IsChaperonedYouth": "false",
        "DailySupervisionFee": "0",
        "FinalFare": "0",
    },
    "SpecialService": {"Fee": "0"},
    "PassengerSpecialService": {"RequestStatus": "Requested", "Fee": "0"},
    "BookingBaggage": {"IsOverLimit": "false", "ExcessFee": "0"},
    "Excursion": {"Price": "0"},
    "VoyageExcursion": {"AvailableSlots": "0"},
    "BookingExcursion": {"BookingDateTime": "now", "ExcursionStatus": "Booked", "AmountPaid": "0"},
    "BookingCancellation": {"CancellationDateTime": "now", "PenaltyAmount": "0", "RefundAmount": "0"},
    "RescheduleRequest": {"RequestDateTime": "now", "RescheduleFee": "0", "RequestStatus": "Requested"},
    "Payment": {"PaymentDateTime": "now", "PaymentStatus": "Pending"},
}
