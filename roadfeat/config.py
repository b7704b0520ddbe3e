"""Regions, radii, column names and the shop category list."""

from __future__ import annotations

POINT_ID = "POINT_ID"

PROJECT_CRS = 5179
LONLAT_CRS = 4326
SIGNAL_CRS = 5186

TARGET_REGION_NAME = "서울시"
TARGET_SIG_CD_PREFIX = "11"
TARGET_SIDO_NAME = "서울특별시"
INCLUDED_ROAD_CLASSES = ("3", "4")

POINT_INTERVAL_M = 25
BUFFER_50M = 50
BUFFER_300M = 300
# Quarter-circle segments of a buffer polygon: 16 gives a 64-gon.
QUAD_SEGS = 16
# How far around the points' bounding box links are looked for.
LINK_BBOX_MARGIN_M = 1000

LAT_RANGE = (37, 38)
LON_RANGE = (126, 128)

# Output column names.
LAT_COLUMN = "위도"
LON_COLUMN = "경도"
RISK_COLUMN = "위험도"
SPEED_LIMIT_COLUMN = "제한속도"
ELDERLY_POPULATION_COLUMN = "고령인구수"
SOCIAL_WELFARE_COLUMN = "사회복지시설개수"
TRADITIONAL_MARKET_COLUMN = "전통시장여부"
BUS_STOP_COLUMN = "버스정류장개수"
BUS_RIDE_ALIGHT_TOTAL_COLUMN = "버스승하차총승객수"
SUBWAY_STATION_COLUMN = "지하철역개수"
STREETLIGHT_COLUMN = "가로등개수"
CCTV_COLUMN = "CCTV개수"
SPEED_BUMP_COLUMN = "과속방지턱개수"
INTERSECTION_COLUMN = "교차로개수"
CROSSWALK_COLUMN = "횡단보도개수"
CROSSWALK_WARNING_COLUMN = "횡단보도예고표시여부"
TRAFFIC_SIGNAL_COLUMN = "신호등설치여부"
PEDESTRIAN_PRIORITY_ROAD_COLUMN = "보행자우선도로여부"
PUBLIC_PARKING_COLUMN = "공영주차장개수"
SENIOR_DISABLED_PROTECTION_ZONE_COLUMN = "노인장애인보호구역여부"

# The 10 major and 75 major_middle shop categories, in output order.
BUSINESS_CATEGORY_COLUMNS = (
    "과학·기술",
    "교육",
    "보건의료",
    "부동산",
    "소매",
    "수리·개인",
    "숙박",
    "시설관리·임대",
    "예술·스포츠",
    "음식",
    "과학·기술_광고",
    "과학·기술_기술 서비스",
    "과학·기술_기타 전문 과학",
    "과학·기술_법무관련",
    "과학·기술_본사·경영 컨설팅",
    "과학·기술_사진 촬영",
    "과학·기술_수의",
    "과학·기술_시장 조사",
    "과학·기술_인쇄·제품제작",
    "과학·기술_전문 디자인",
    "과학·기술_회계·세무",
    "교육_교육 지원",
    "교육_기타 교육",
    "교육_일반 교육",
    "보건의료_기타 보건",
    "보건의료_병원",
    "보건의료_의원",
    "부동산_부동산 서비스",
    "소매_가구 소매",
    "소매_가전·통신 소매",
    "소매_기타 상품 소매",
    "소매_기타 생활용품 소매",
    "소매_담배 소매",
    "소매_모터사이클 소매",
    "소매_섬유·의복·신발 소매",
    "소매_시계·귀금속 소매",
    "소매_식료품 소매",
    "소매_식물 소매",
    "소매_안경·정밀기기 소매",
    "소매_애완동물·용품 소매",
    "소매_연료 소매",
    "소매_오락용품 소매",
    "소매_음료 소매",
    "소매_의약·화장품 소매",
    "소매_자동차 부품 소매",
    "소매_장식품 소매",
    "소매_종합 소매",
    "소매_중고 상품 소매",
    "소매_철물·건설자재 소매",
    "수리·개인_가전제품 수리",
    "수리·개인_기타 가정용품 수리",
    "수리·개인_기타 개인",
    "수리·개인_모터사이클 수리",
    "수리·개인_세탁",
    "수리·개인_욕탕·신체관리",
    "수리·개인_이용·미용",
    "수리·개인_자동차 수리·세차",
    "수리·개인_장례식장",
    "수리·개인_컴퓨터 수리",
    "수리·개인_통신장비 수리",
    "숙박_기타 숙박",
    "숙박_일반 숙박",
    "시설관리·임대_가정용품 대여",
    "시설관리·임대_고용 알선",
    "시설관리·임대_기타 사업 서비스",
    "시설관리·임대_사무 지원",
    "시설관리·임대_산업용품 대여",
    "시설관리·임대_시설관리",
    "시설관리·임대_여행사·보조",
    "시설관리·임대_운송장비 대여",
    "시설관리·임대_조경·유지",
    "시설관리·임대_청소·방제",
    "예술·스포츠_도서관·사적지",
    "예술·스포츠_스포츠 서비스",
    "예술·스포츠_유원지·오락",
    "음식_구내식당·뷔페",
    "음식_기타 간이",
    "음식_기타 외국",
    "음식_동남아시아",
    "음식_비알코올",
    "음식_서양식",
    "음식_일식",
    "음식_주점",
    "음식_중식",
    "음식_한식",
)

# Column order of the saved wide table.
FINAL_COLUMNS = (
    POINT_ID,
    LAT_COLUMN,
    LON_COLUMN,
    SPEED_LIMIT_COLUMN,
    RISK_COLUMN,
    ELDERLY_POPULATION_COLUMN,
    SOCIAL_WELFARE_COLUMN,
    TRADITIONAL_MARKET_COLUMN,
    BUS_STOP_COLUMN,
    BUS_RIDE_ALIGHT_TOTAL_COLUMN,
    SUBWAY_STATION_COLUMN,
    STREETLIGHT_COLUMN,
    CCTV_COLUMN,
    SPEED_BUMP_COLUMN,
    INTERSECTION_COLUMN,
    CROSSWALK_COLUMN,
    CROSSWALK_WARNING_COLUMN,
    TRAFFIC_SIGNAL_COLUMN,
    PEDESTRIAN_PRIORITY_ROAD_COLUMN,
    PUBLIC_PARKING_COLUMN,
    SENIOR_DISABLED_PROTECTION_ZONE_COLUMN,
    *BUSINESS_CATEGORY_COLUMNS,
)
