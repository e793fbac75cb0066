"""Relational model of the reservation data: one explicit schema per table, never inferred."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Table and column names, types and nullability of the data model.
TABLES: dict[str, str] = {
    "CruiseOperator": "OperatorID bigint not null, OperatorName string not null, HeadquartersCountry string not null, ContactEmail string, AllowsChaperonedYouth boolean not null",
    "CruiseShip": "ShipID bigint not null, OperatorID bigint not null, ShipName string not null, TotalDecks int not null, PassengerCapacity int not null",
    "CabinCategory": "CabinCategoryID bigint not null, CategoryName string not null, CategoryDescription string",
    "Cabin": "CabinID bigint not null, ShipID bigint not null, CabinCategoryID bigint not null, CabinNumber string not null, DeckNumber int not null, MaxOccupancy int not null, IsWheelchairAccessible boolean not null",
    "CabinAdjacency": "CabinAdjacencyID bigint not null, CabinID bigint not null, AdjacentCabinID bigint not null, AdjacencyType string not null",
    "CruiseRoute": "RouteID bigint not null, RouteName string not null, RouteType string not null",
    "Port": "PortID bigint not null, PortName string not null, Country string not null",
    "RoutePort": "RoutePortID bigint not null, RouteID bigint not null, PortID bigint not null, StopSequence int not null, IsHomePort boolean not null",
    "CruiseVoyage": "VoyageID bigint not null, ShipID bigint not null, RouteID bigint not null, DepartureDateTime timestamp_ntz not null, ArrivalDateTime timestamp_ntz not null, BaggageWeightLimitKG decimal(6,2) not null, VoyageStatus string not null",
    "Passenger": "PassengerID bigint not null, FullName string not null, DateOfBirth date not null, PassportNo string not null, Nationality string not null, Gender string, ContactNo string, Email string",
    "AgeCategory": "AgeCategoryID bigint not null, CategoryName string not null, MinAge int not null, MaxAge int",
    "Booking": "BookingID bigint not null, BookingDate timestamp_ntz not null, CustomerPassengerID bigint not null, VoyageID bigint not null, BookingStatus string not null, TotalAmount decimal(12,2) not null, OriginalBookingID bigint",
    "BookingCabin": "BookingCabinID bigint not null, BookingID bigint not null, CabinID bigint not null, CabinPrice decimal(12,2) not null",
    "FareRule": "FareRuleID bigint not null, VoyageID bigint not null, CabinCategoryID bigint not null, AgeCategoryID bigint not null, BaseFare decimal(12,2) not null, EffectiveFrom date not null, EffectiveTo date",
    "BookingPassenger": "BookingPassengerID bigint not null, BookingID bigint not null, BookingCabinID bigint not null, PassengerID bigint not null, AgeCategoryID bigint not null, FareRuleID bigint, InfantBedOption string not null, IsChaperonedYouth boolean not null, DailySupervisionFee decimal(10,2) not null, FinalFare decimal(12,2) not null",
    "DiningOption": "DiningOptionID bigint not null, DiningName string not null",
    "ShipDiningOption": "ShipDiningOptionID bigint not null, ShipID bigint not null, DiningOptionID bigint not null",
    "SpecialtyDiningType": "SpecialtyDiningTypeID bigint not null, TypeName string not null, Description string",
    "ShipSpecialtyDining": "ShipSpecialtyDiningID bigint not null, ShipID bigint not null, SpecialtyDiningTypeID bigint not null",
    "VoyageMealPackageType": "MealPackageTypeID bigint not null, PackageName string not null",
    "VoyageMealPackageRule": "MealPackageRuleID bigint not null, MealPackageTypeID bigint not null, MinVoyageLengthDays int not null, MaxVoyageLengthDays int",
    "VoyageMealPackage": "VoyageMealPackageID bigint not null, VoyageID bigint not null, MealPackageRuleID bigint not null",
    "SpecialService": "ServiceID bigint not null, ServiceName string not null, ServiceType string not null, AgeRestrictionMin int, AgeRestrictionMax int, Fee decimal(10,2) not null",
    "PassengerSpecialService": "PassengerServiceID bigint not null, BookingPassengerID bigint not null, ServiceID bigint not null, RequestStatus string not null, Fee decimal(10,2) not null",
    "BaggageRule": "BaggageRuleID bigint not null, OperatorID bigint not null, MaxWeightKG decimal(6,2) not null, EffectiveFrom date not null, EffectiveTo date",
    "BookingBaggage": "BaggageID bigint not null, BookingPassengerID bigint not null, WeightKG decimal(6,2) not null, IsOverLimit boolean not null, ExcessFee decimal(10,2) not null",
    "Excursion": "ExcursionID bigint not null, PortID bigint not null, ExcursionName string not null, Description string, DurationHours decimal(5,2) not null, Price decimal(10,2) not null",
    "VoyageExcursion": "VoyageExcursionID bigint not null, VoyageID bigint not null, RoutePortID bigint not null, ExcursionID bigint not null, AvailableSlots int not null",
    "BookingExcursion": "BookingExcursionID bigint not null, BookingPassengerID bigint not null, VoyageExcursionID bigint not null, BookingDateTime timestamp_ntz not null, ExcursionStatus string not null, AmountPaid decimal(10,2) not null",
    "CancellationPolicy": "PolicyID bigint not null, OperatorID bigint not null, HoursBeforeDeparture int not null, PenaltyType string not null, PenaltyValue decimal(10,2) not null",
    "BookingCancellation": "CancellationID bigint not null, BookingID bigint not null, CancellationDateTime timestamp_ntz not null, Reason string, PenaltyAmount decimal(12,2) not null, RefundAmount decimal(12,2) not null, ProcessedBy string",
    "RescheduleRequest": "RescheduleID bigint not null, OriginalBookingID bigint not null, NewBookingID bigint, RequestDateTime timestamp_ntz not null, NewVoyageID bigint not null, RescheduleFee decimal(12,2) not null, RequestStatus string not null, Reason string",
    "Payment": "PaymentID bigint not null, BookingID bigint not null, PaymentDateTime timestamp_ntz not null, Amount decimal(12,2) not null, PaymentMethod string not null, PaymentStatus string not null, TransactionReference string",
}

# Three different meanings of an "active" row are in use; each report or rule names the one it needs.
SOLD = ("Confirmed", "Completed")  # counts as revenue
HOLDING = ("Pending", "Confirmed")  # occupies a cabin
EXC_SOLD = ("Booked", "Completed")  # excursion sale
LIVE_VOYAGE = ("Scheduled", "Boarding", "Departed")  # voyage will dock
WHEELCHAIR_TYPES = ("Accessibility", "Mobility")
OPEN_REQUESTS = ("Requested", "Approved", "Completed")

# Wording of the reservation status report.
STATUS_TEXT = {
    "Pending": "Booking submitted and awaiting confirmation",
    "Confirmed": "Reservation is confirmed and active",
    "Waitlisted": "Passenger is on the waiting list pending availability",
    "Rescheduled": "Booking has been moved to a new voyage",
    "Cancelled": "Reservation has been cancelled",
    "Completed": "Voyage has been successfully completed",
}
STATUS_TEXT_UNKNOWN = "Status unknown"


def struct_of(table: str) -> StructType:
    """The declared ``StructType`` of a table."""
    return StructType.fromDDL(TABLES[table])
