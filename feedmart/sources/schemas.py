"""Read schemas of the two feeds and column types of the output tables (fixed values)."""

from __future__ import annotations

from pyspark.sql.types import StructType

_PRICE = "struct<Fare:string,NaverFare:string,Tax:string,QCharge:string>"
_CDATA = "struct<`#cdata-section`:string>"

_DOMESTIC_FARE = (
    "struct<agtCode:string,bookingClass:string,adultFare:int,childFare:int,aFuel:int,cFuel:int,"
    "aTax:int,cTax:int,publishFee:int,etc:string,supportNPay:boolean,discountFare:string>"
)

_DOMESTIC_SCHEDULE = (
    "struct<airlineCode:string,airlineName:string,codeshare:string,fitName:string,"
    "depCity:string,arrCity:string,departureCityName:string,arrivalCityName:string,"
    "departureDate:string,arrivalDate:string,dayDiff:int,departureTime:string,"
    "arrivalTime:string,detailedClass:string,seatClass:string,seatCnt:int,journeyTime:string,"
    f"minFare:int,supportNPay:boolean,fare:array<{_DOMESTIC_FARE}>>"
)

_LEG = (
    "struct<sa:string,ea:string,av:string,fn:string,sdt:string,edt:string,oav:string,jt:string,"
    "ft:string,ct:string,et:string,im:boolean,carbonEmission:double>"
)

_ITINERARY = f"struct<id:string,detail:array<{_LEG}>,journeyTime:array<string>>"

_INTERNATIONAL_FARE = (
    f"struct<Adult:{_PRICE},Child:{_PRICE},Infant:{_PRICE},ReserveParameter:{_CDATA},"
    f"PromotionParameter:{_CDATA},FareType:string,AgtCode:string,ConfirmType:string,"
    f"BaggageType:string,priceTransparencyUrl:{_CDATA}>"
)

_RESULTS = (
    "struct<airlines:map<string,string>,airports:map<string,string>,fareTypes:map<string,string>,"
    f"schedules:array<map<string,{_ITINERARY}>>,"
    f"fares:map<string,struct<sch:array<string>,fare:map<string,array<{_INTERNATIONAL_FARE}>>>>,"
    "errors:array<struct<agtCode:string,errCode:string,errMsg:string>>,"
    "carbonEmissionAverage:struct<"
    "directFlightCarbonEmissionItineraryAverage:map<string,double>,"
    "directFlightCarbonEmissionAverage:double>>"
)

DOMESTIC = (
    f"data struct<domesticFlights:struct<departures:array<{_DOMESTIC_SCHEDULE}>,"
    f"arrivals:array<{_DOMESTIC_SCHEDULE}>>,promotions:array<string>>"
)

INTERNATIONAL = (
    "data struct<internationalList:struct<galileoKey:string,galileoFlag:boolean,"
    "travelBizKey:string,travelBizFlag:boolean,totalResCnt:int,resCnt:int,"
    f"results:{_RESULTS}>>"
)

FLIGHT_INFO = (
    "air_id string,airline string,depart_airport string,depart_timestamp timestamp,"
    "arrival_airport string,arrival_timestamp timestamp,journey_time int,is_layover boolean"
)

FARE_INFO = (
    "air_id string,seat_class string,agt_code string,adult_fare int,fetched_date date,"
    "fare_class string"
)

LAYOVER_INFO = "air_id string,segment_id string,layover_order int,connect_time int"

DAILY_ROLLUP = (
    "depart_airport string,arrival_airport string,depart_date date,is_layover boolean,"
    "airline string,seat_class string,fare_class string,fetched_date date,mean_price int,"
    "median_price int,ticket_count bigint"
)

AIRPORT_INFO = "airport_code string,name string,country string,time_zone string"

BATCH_COUNTS = (
    "feed string,batch_id bigint,records bigint,bad bigint,unkeyed bigint,dropped bigint,"
    "flight_info bigint,fare_info bigint,layover_info bigint"
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
