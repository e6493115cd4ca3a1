"""Layouts of parameter groups: where the bits of each value are, and what they are turned into.

A layout is data. A value has a first bit and a width, at any place; after a text of
variable length it is counted from the text's end. A group may end in sets of
values that repeat, as many as one of its fields says.
"""

from __future__ import annotations

from dataclasses import dataclass, field

DEG, KN, CELSIUS = "deg", "kn", "celsius"


@dataclass(frozen=True)
class Number:
    """A little-endian number: name, byte offset, bytes, resolution, and what it is turned into.

    bit: bits from that byte's lowest to the first; bits: the width, where it is no whole bytes;
    after: how many texts of variable length come before, from the last of which the offset counts.
    """

    name: str
    offset: int
    size: int
    scale: float = 1.0
    signed: bool = False
    unit: str | None = None
    fold: bool = False
    bit: int = 0
    bits: int = 0
    after: int = 0

    @property
    def first(self) -> int:
        return 8 * self.offset + self.bit

    @property
    def width(self) -> int:
        return self.bits or 8 * self.size


@dataclass(frozen=True)
class Code:
    """A lookup, stored as its number; known: the greatest code that has a meaning."""

    name: str
    offset: int
    shift: int
    width: int
    known: int


@dataclass(frozen=True)
class Split:
    """A discriminator: its text, or number, goes into the column names of the message."""

    key: str
    offset: int
    shift: int = 0
    width: int = 8
    texts: tuple[tuple[int, str], ...] = ()


@dataclass(frozen=True)
class Sets:
    """Values that repeat: the byte and bits of their count, where the first set begins, the bits of a set without its texts, and bytes before each text."""

    count: tuple[int, int]
    start: int
    bits: int
    values: tuple[Number, ...]
    texts: tuple[int, ...] = ()


@dataclass(frozen=True)
class Layout:
    values: tuple[Number | Code, ...]
    splits: tuple[Split, ...] = ()
    fast: bool = False
    clock: tuple[int, int] | None = None  # offsets of days and of 0.0001 seconds
    texts: tuple[int, ...] = ()  # bytes before each text of variable length, from the last one's end
    sets: Sets | None = field(default=None)


# Layouts of the public parameter groups.
DIRECTION = ((0, "True"), (1, "Magnetic"))
WIND = ((0, "True (ground referenced to North)"), (1, "Magnetic (ground referenced to Magnetic North)"), (2, "Apparent"), (3, "True (boat referenced)"), (4, "True (water referenced)"))
TEMPERATURE = ((0, "Sea Temperature"), (1, "Outside Temperature"), (2, "Inside Temperature"), (3, "Engine Room Temperature"), (4, "Main Cabin Temperature"))
PRESSURE = ((0, "Atmospheric"), (1, "Water"), (2, "Steam"), (3, "Compressed Air"), (4, "Hydraulic"))
ENGINE = ((0, "Single Engine or Dual Engine Port"), (1, "Dual Engine Starboard"))
FLUID = ((0, "Fuel"), (1, "Water"), (2, "Gray water"), (3, "Live well"), (4, "Oil"), (5, "Black water"))
HUMIDITY = ((0, "Inside"), (1, "Outside"))
CLOCK = ((0, "GPS"), (1, "GLONASS"), (2, "Radio Station"), (3, "Local Cesium clock"), (4, "Local Rubidium clock"), (5, "Local Crystal clock"))
VARIATION = ((0, "Manual"), (1, "Automatic Chart"), (2, "Automatic Table"), (3, "Automatic Calculation"), (4, "WMM 2000"), (5, "WMM 2005"), (6, "WMM 2010"), (7, "WMM 2015"), (8, "WMM 2020"))

LAYOUTS: dict[int, Layout] = {
    126992: Layout((), (Split("source", 1, 0, 4, CLOCK),), clock=(2, 4)),
    127245: Layout((Number("position", 4, 2, 1e-4, True, DEG), Number("angleOrder", 2, 2, 1e-4, True)), (Split("instance", 0),)),
    127250: Layout((Number("heading", 1, 2, 1e-4, False, DEG), Number("deviation", 3, 2, 1e-4, True), Number("variation", 5, 2, 1e-4, True, DEG)), (Split("reference", 7, 0, 2, DIRECTION),)),
    127251: Layout((Number("rate", 1, 4, 3.125e-8, True, DEG),)),
    127257: Layout((Number("yaw", 1, 2, 1e-4, True, DEG), Number("pitch", 3, 2, 1e-4, True, DEG), Number("roll", 5, 2, 1e-4, True, DEG))),
    127258: Layout((Number("variation", 4, 2, 1e-4, True, DEG),), (Split("source", 1, 0, 4, VARIATION),)),
    127508: Layout((Number("voltage", 1, 2, 0.01, True), Number("current", 3, 2, 0.1, True), Number("temperature", 5, 2, 0.01, False, CELSIUS)), (Split("instance", 0),)),
    128000: Layout((Number("leewayAngle", 1, 2, 1e-4, True, DEG),)),
    128259: Layout((Number("speedWaterReferenced", 1, 2, 0.01, False, KN), Number("speedGroundReferenced", 3, 2, 0.01), Code("speedWaterReferencedType", 5, 0, 8, 4))),
    128267: Layout((Number("depth", 1, 4, 0.01), Number("offset", 5, 2, 0.001, True))),
    128275: Layout((Number("log", 6, 4), Number("tripLog", 10, 4)), fast=True),
    129025: Layout((Number("latitude", 0, 4, 1e-7, True), Number("longitude", 4, 4, 1e-7, True))),
    129026: Layout((Code("cogReference", 1, 0, 2, 1), Number("cog", 2, 2, 1e-4, False, DEG), Number("sog", 4, 2, 0.01, False, KN))),
    129029: Layout(
        (
            Number("latitude", 7, 8, 1e-16, True), Number("longitude", 15, 8, 1e-16, True), Number("altitude", 23, 8, 1e-6, True),
            Code("gnssType", 31, 0, 4, 8), Code("method", 31, 4, 4, 8), Code("integrity", 32, 0, 2, 2),
            Number("numberOfSvs", 33, 1), Number("hdop", 34, 2, 0.01, True), Number("pdop", 36, 2, 0.01, True),
        ), fast=True, clock=(1, 3),
        sets=Sets((42, 8), 43, 32, (Number("referenceStationId", 0, 0, bit=4, bits=12), Number("ageOfDgnssCorrections", 2, 2, 0.01))),
    ),
    129291: Layout((Code("setReference", 1, 0, 2, 1), Number("set", 2, 2, 1e-4, False, DEG), Number("drift", 4, 2, 0.01, False, KN))),
    129539: Layout((Number("hdop", 2, 2, 0.01, True), Number("vdop", 4, 2, 0.01, True), Number("tdop", 6, 2, 0.01, True))),
    130306: Layout((Number("windSpeed", 1, 2, 0.01, False, KN), Number("windAngle", 3, 2, 1e-4, False, DEG, fold=True)), (Split("reference", 5, 0, 3, WIND),)),
    130310: Layout((Number("waterTemperature", 1, 2, 0.01, False, CELSIUS), Number("outsideAmbientAirTemperature", 3, 2, 0.01, False, CELSIUS), Number("atmosphericPressure", 5, 2, 100.0))),
    130312: Layout((Number("actualTemperature", 3, 2, 0.01, False, CELSIUS), Number("setTemperature", 5, 2, 0.01, False, CELSIUS)), (Split("instance", 1), Split("source", 2, 0, 8, TEMPERATURE))),
    130314: Layout((Number("pressure", 3, 4, 0.1, True),), (Split("instance", 1), Split("source", 2, 0, 8, PRESSURE))),
    130316: Layout((Number("temperature", 3, 3, 0.001, False, CELSIUS), Number("setTemperature", 6, 2, 0.1, False, CELSIUS)), (Split("instance", 1), Split("source", 2, 0, 8, TEMPERATURE))),
    127252: Layout((Number("heave", 1, 2, 0.01, True),)),
    127488: Layout((Number("speed", 1, 2, 0.25), Number("boostPressure", 3, 2, 100.0), Number("tiltTrim", 5, 1, 1.0, True)), (Split("instance", 0, 0, 8, ENGINE),)),
    127489: Layout(
        (
            Number("oilPressure", 1, 2, 100.0), Number("oilTemperature", 3, 2, 0.1), Number("temperature", 5, 2, 0.01, False, CELSIUS), Number("alternatorPotential", 7, 2, 0.01, True),
            Number("fuelRate", 9, 2, 0.1, True), Number("totalEngineHours", 11, 4), Number("coolantPressure", 15, 2, 100.0), Number("fuelPressure", 17, 2, 1000.0),
            Number("engineLoad", 24, 1, 1.0, True), Number("engineTorque", 25, 1, 1.0, True),
        ), (Split("instance", 0, 0, 8, ENGINE),), fast=True,
    ),
    127505: Layout((Number("level", 1, 2, 0.004, True), Number("capacity", 3, 4, 0.1)), (Split("instance", 0, 0, 4), Split("type", 0, 4, 4, FLUID))),
    129038: Layout(
        (
            Number("userId", 1, 4), Number("longitude", 5, 4, 1e-7, True), Number("latitude", 9, 4, 1e-7, True), Code("positionAccuracy", 13, 0, 1, 1), Code("raim", 13, 1, 1, 1),
            Number("cog", 14, 2, 1e-4, False, DEG), Number("sog", 16, 2, 0.01, False, KN), Code("aisTransceiverInformation", 20, 3, 5, 4), Number("heading", 21, 2, 1e-4, False, DEG),
            Number("rateOfTurn", 23, 2, 3.125e-5, True), Code("navStatus", 25, 0, 4, 15),
        ), fast=True,
    ),
    129283: Layout((Code("xteMode", 1, 0, 4, 4), Code("navigationTerminated", 1, 6, 2, 1), Number("xte", 2, 4, 0.01, True))),
    129284: Layout(
        (
            Number("distanceToWaypoint", 1, 4, 0.01), Code("courseBearingReference", 5, 0, 2, 1), Code("perpendicularCrossed", 5, 2, 2, 1), Code("arrivalCircleEntered", 5, 4, 2, 1), Code("calculationType", 5, 6, 2, 1),
            Number("bearingOriginToDestinationWaypoint", 12, 2, 1e-4), Number("bearingPositionToDestinationWaypoint", 14, 2, 1e-4), Number("originWaypointNumber", 16, 4), Number("destinationWaypointNumber", 20, 4),
            Number("destinationLatitude", 24, 4, 1e-7, True), Number("destinationLongitude", 28, 4, 1e-7, True), Number("waypointClosingVelocity", 32, 2, 0.01, True),
        ), fast=True,
    ),
    129285: Layout(
        (Number("startRps", 0, 2), Number("nitems", 2, 2), Number("databaseId", 4, 2), Number("routeId", 6, 2)), fast=True, texts=(9,),
        sets=Sets((2, 16), 1, 80, (Number("wpId", 0, 2), Number("wpLatitude", 0, 4, 1e-7, True, after=1), Number("wpLongitude", 4, 4, 1e-7, True, after=1)), texts=(2,)),
    ),
    129540: Layout((Code("rangeResidualMode", 1, 0, 2, 1), Number("satsInView", 2, 1)), fast=True, sets=Sets((2, 8), 3, 96, (
        Number("prn", 0, 1), Number("elevation", 1, 2, 1e-4, True), Number("azimuth", 3, 2, 1e-4), Number("snr", 5, 2, 0.01), Number("rangeResiduals", 7, 4, 1e-5, True), Number("status", 11, 0, bits=4),
    ))),
    130311: Layout((Code("humiditySource", 1, 6, 2, 1), Number("temperature", 2, 2, 0.01, False, CELSIUS), Number("humidity", 4, 2, 0.004, True), Number("atmosphericPressure", 6, 2, 100.0)), (Split("temperatureSource", 1, 0, 6, TEMPERATURE),)),
    130313: Layout((Number("actualHumidity", 3, 2, 0.004, True), Number("setHumidity", 5, 2, 0.004, True)), (Split("instance", 1), Split("source", 2, 0, 8, HUMIDITY))),
    130576: Layout((Number("portTrimTab", 0, 1, 1.0, True), Number("starboardTrimTab", 1, 1, 1.0, True))),
    130577: Layout(
        (
            Code("dataMode", 0, 0, 4, 4), Code("cogReference", 0, 4, 2, 1), Number("cog", 2, 2, 1e-4, False, DEG), Number("sog", 4, 2, 0.01, False, KN), Number("heading", 6, 2, 1e-4, False, DEG),
            Number("speedThroughWater", 8, 2, 0.01), Number("set", 10, 2, 1e-4, False, DEG), Number("drift", 12, 2, 0.01, False, KN),
        ), fast=True,
    ),
}
#: The vendor's key-value group: which maker and industry, and the keys read as signed 16-bit counts.
VENDOR_GROUP, VENDOR_MAKER, MARINE = 130824, 381, 4
VENDOR_KEYS = {
    0x42: "n2k_bandg_raw_bsp",
    0x4A: "n2k_bandg_raw_heading",
    0x4E: "n2k_bandg_raw_wind_s",
    0x52: "n2k_bandg_raw_wind_a",
}
