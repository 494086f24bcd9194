"""25 sample rows of each kind, and the results they must give."""

TRANSACTIONS = """\
TXN001,USR123,2024-06-12T09:15:32Z,Electronics,149.99,North America
TXN002,USR456,2024-06-12T09:16:45Z,Clothing,89.50,Europe
TXN003,USR789,2024-06-12T09:17:12Z,Electronics,299.99,Asia
TXN004,USR123,2024-06-12T09:18:22Z,Books,24.99,North America
TXN005,USR999,2024-06-12T09:19:05Z,Electronics,199.99,North America
TXN006,USR234,2024-06-12T09:20:15Z,Home & Garden,65.75,Europe
TXN007,USR567,2024-06-12T09:21:32Z,Sports,129.99,Asia
TXN008,USR890,2024-06-12T09:22:45Z,Electronics,449.99,North America
TXN009,USR123,2024-06-12T09:23:10Z,Clothing,49.99,North America
TXN010,USR456,2024-06-12T09:24:22Z,Books,19.99,Europe
TXN011,USR112,2024-06-12T10:15:05Z,Electronics,189.99,Asia
TXN012,USR334,2024-06-12T10:16:30Z,Clothing,75.25,North America
TXN013,USR556,2024-06-12T10:17:45Z,Home & Garden,99.99,Europe
TXN014,USR778,2024-06-12T10:18:12Z,Sports,159.99,Asia
TXN015,USR890,2024-06-12T10:19:33Z,Electronics,279.99,North America
TXN016,USR111,2024-06-12T11:05:22Z,Books,34.99,Europe
TXN017,USR333,2024-06-12T11:06:45Z,Electronics,119.99,Asia
TXN018,USR555,2024-06-12T11:07:15Z,Clothing,59.99,North America
TXN019,USR777,2024-06-12T11:08:32Z,Home & Garden,89.99,Europe
TXN020,USR999,2024-06-12T11:09:50Z,Sports,199.99,Asia
TXN021,USR222,2024-06-12T12:15:10Z,Electronics,249.99,North America
TXN022,USR444,2024-06-12T12:16:25Z,Books,29.99,Asia
TXN023,USR666,2024-06-12T12:17:40Z,Clothing,69.99,Europe
TXN024,USR888,2024-06-12T12:18:55Z,Home & Garden,119.99,North America
TXN025,USR101,2024-06-12T12:20:12Z,Sports,179.99,Asia
"""

SENSORS = """\
SENSOR001,IOT_DEV_001,2024-06-12T10:00:00Z,22.5,45.2,Building_A_Floor_1
SENSOR002,IOT_DEV_002,2024-06-12T10:00:15Z,23.1,48.9,Building_A_Floor_2
SENSOR003,IOT_DEV_003,2024-06-12T10:00:30Z,21.8,42.1,Building_B_Floor_1
SENSOR001,IOT_DEV_001,2024-06-12T10:01:00Z,22.7,45.5,Building_A_Floor_1
SENSOR002,IOT_DEV_002,2024-06-12T10:01:15Z,23.3,49.2,Building_A_Floor_2
SENSOR003,IOT_DEV_003,2024-06-12T10:01:30Z,21.9,42.5,Building_B_Floor_1
SENSOR001,IOT_DEV_001,2024-06-12T10:02:00Z,22.6,45.8,Building_A_Floor_1
SENSOR002,IOT_DEV_002,2024-06-12T10:02:15Z,23.2,49.0,Building_A_Floor_2
SENSOR003,IOT_DEV_003,2024-06-12T10:02:30Z,22.0,42.8,Building_B_Floor_1
SENSOR001,IOT_DEV_001,2024-06-12T10:03:00Z,22.4,45.1,Building_A_Floor_1
SENSOR002,IOT_DEV_002,2024-06-12T10:03:15Z,23.0,48.7,Building_A_Floor_2
SENSOR003,IOT_DEV_003,2024-06-12T10:03:30Z,21.7,41.9,Building_B_Floor_1
SENSOR004,IOT_DEV_004,2024-06-12T10:04:00Z,24.2,50.1,Building_B_Floor_2
SENSOR005,IOT_DEV_005,2024-06-12T10:04:15Z,20.5,40.2,Building_C_Floor_1
SENSOR004,IOT_DEV_004,2024-06-12T10:04:30Z,24.5,50.5,Building_B_Floor_2
SENSOR005,IOT_DEV_005,2024-06-12T10:04:45Z,20.8,40.5,Building_C_Floor_1
SENSOR001,IOT_DEV_001,2024-06-12T10:05:00Z,22.8,46.0,Building_A_Floor_1
SENSOR002,IOT_DEV_002,2024-06-12T10:05:15Z,23.4,49.5,Building_A_Floor_2
SENSOR003,IOT_DEV_003,2024-06-12T10:05:30Z,22.1,43.0,Building_B_Floor_1
SENSOR004,IOT_DEV_004,2024-06-12T10:05:45Z,24.0,49.8,Building_B_Floor_2
SENSOR001,IOT_DEV_001,2024-06-12T10:06:00Z,22.3,45.0,Building_A_Floor_1
SENSOR002,IOT_DEV_002,2024-06-12T10:06:15Z,23.5,49.8,Building_A_Floor_2
SENSOR003,IOT_DEV_003,2024-06-12T10:06:30Z,22.2,43.2,Building_B_Floor_1
SENSOR004,IOT_DEV_004,2024-06-12T10:06:45Z,24.3,50.2,Building_B_Floor_2
SENSOR005,IOT_DEV_005,2024-06-12T10:07:00Z,20.9,40.8,Building_C_Floor_1
"""

ACTIVITY = """\
EVT001,USR123,2024-06-12T14:00:00Z,PAGE_VIEW,home,SESS_123_001
EVT002,USR123,2024-06-12T14:00:45Z,CLICK,product_link,SESS_123_001
EVT003,USR123,2024-06-12T14:01:30Z,ADD_TO_CART,item_added,SESS_123_001
EVT004,USR456,2024-06-12T14:05:00Z,PAGE_VIEW,home,SESS_456_001
EVT005,USR456,2024-06-12T14:05:32Z,SEARCH,query_entered,SESS_456_001
EVT006,USR123,2024-06-12T14:35:00Z,PAGE_VIEW,home,SESS_123_002
EVT007,USR789,2024-06-12T14:40:15Z,PAGE_VIEW,home,SESS_789_001
EVT008,USR789,2024-06-12T14:41:00Z,CLICK,category_link,SESS_789_001
EVT009,USR456,2024-06-12T14:45:20Z,PAGE_VIEW,product_detail,SESS_456_002
EVT010,USR234,2024-06-12T14:50:10Z,PAGE_VIEW,home,SESS_234_001
EVT011,USR234,2024-06-12T14:50:55Z,SEARCH,query_entered,SESS_234_001
EVT012,USR234,2024-06-12T14:51:35Z,CLICK,product_link,SESS_234_001
EVT013,USR123,2024-06-12T15:00:05Z,PAGE_VIEW,cart,SESS_123_003
EVT014,USR567,2024-06-12T15:05:25Z,PAGE_VIEW,home,SESS_567_001
EVT015,USR567,2024-06-12T15:06:10Z,ADD_TO_CART,item_added,SESS_567_001
EVT016,USR890,2024-06-12T15:10:30Z,PAGE_VIEW,home,SESS_890_001
EVT017,USR890,2024-06-12T15:11:15Z,SEARCH,query_entered,SESS_890_001
EVT018,USR456,2024-06-12T15:20:45Z,PAGE_VIEW,home,SESS_456_003
EVT019,USR111,2024-06-12T15:25:00Z,PAGE_VIEW,home,SESS_111_001
EVT020,USR111,2024-06-12T15:25:45Z,CLICK,product_link,SESS_111_001
EVT021,USR222,2024-06-12T15:30:15Z,PAGE_VIEW,home,SESS_222_001
EVT022,USR222,2024-06-12T15:31:00Z,ADD_TO_CART,item_added,SESS_222_001
EVT023,USR333,2024-06-12T15:35:30Z,PAGE_VIEW,home,SESS_333_001
EVT024,USR333,2024-06-12T15:36:20Z,SEARCH,query_entered,SESS_333_001
EVT025,USR444,2024-06-12T15:40:00Z,PAGE_VIEW,product_detail,SESS_444_001
"""

# hour, region, total, count, mean, most frequent category
HOURLY_SALES = [
    (9, "Asia", 429.98, 2, 214.99, "Electronics"), (9, "Europe", 175.24, 3, 58.41, "Books"),
    (9, "North America", 874.95, 5, 174.99, "Electronics"), (10, "Asia", 349.98, 2, 174.99, "Electronics"),
    (10, "Europe", 99.99, 1, 99.99, "Home & Garden"), (10, "North America", 355.24, 2, 177.62, "Clothing"),
    (11, "Asia", 319.98, 2, 159.99, "Electronics"), (11, "Europe", 124.98, 2, 62.49, "Books"),
    (11, "North America", 59.99, 1, 59.99, "Clothing"), (12, "Asia", 209.98, 2, 104.99, "Books"),
    (12, "Europe", 69.99, 1, 69.99, "Clothing"), (12, "North America", 369.98, 2, 184.99, "Electronics"),
]

# window start, sensor, mean temperature, mean humidity, max, min, readings
SENSOR_WINDOWS = [
    ("09:55", "SENSOR001", 22.55, 45.4, 22.7, 22.4, 4), ("09:55", "SENSOR002", 23.15, 48.95, 23.3, 23.0, 4),
    ("09:55", "SENSOR003", 21.85, 42.32, 22.0, 21.7, 4), ("09:55", "SENSOR004", 24.35, 50.3, 24.5, 24.2, 2),
    ("09:55", "SENSOR005", 20.65, 40.35, 20.8, 20.5, 2), ("10:00", "SENSOR001", 22.55, 45.43, 22.8, 22.3, 6),
    ("10:00", "SENSOR002", 23.25, 49.18, 23.5, 23.0, 6), ("10:00", "SENSOR003", 21.95, 42.58, 22.2, 21.7, 6),
    ("10:00", "SENSOR004", 24.25, 50.15, 24.5, 24.0, 4), ("10:00", "SENSOR005", 20.73, 40.5, 20.9, 20.5, 3),
    ("10:05", "SENSOR001", 22.55, 45.5, 22.8, 22.3, 2), ("10:05", "SENSOR002", 23.45, 49.65, 23.5, 23.4, 2),
    ("10:05", "SENSOR003", 22.15, 43.1, 22.2, 22.1, 2), ("10:05", "SENSOR004", 24.15, 50.0, 24.3, 24.0, 2),
    ("10:05", "SENSOR005", 20.9, 40.8, 20.9, 20.9, 1),
]

# user, window start, window end (with the gap of 30 minutes), events, id of the first event's session
SESSIONS_30 = [
    ("USR111", "15:25:00", "15:55:45", 2, "SESS_111_001"), ("USR123", "14:00:00", "14:31:30", 3, "SESS_123_001"),
    ("USR123", "14:35:00", "15:30:05", 2, "SESS_123_002"), ("USR222", "15:30:15", "16:01:00", 2, "SESS_222_001"),
    ("USR234", "14:50:10", "15:21:35", 3, "SESS_234_001"), ("USR333", "15:35:30", "16:06:20", 2, "SESS_333_001"),
    ("USR444", "15:40:00", "16:10:00", 1, "SESS_444_001"), ("USR456", "14:05:00", "14:35:32", 2, "SESS_456_001"),
    ("USR456", "14:45:20", "15:15:20", 1, "SESS_456_002"), ("USR456", "15:20:45", "15:50:45", 1, "SESS_456_003"),
    ("USR567", "15:05:25", "15:36:10", 2, "SESS_567_001"), ("USR789", "14:40:15", "15:11:00", 2, "SESS_789_001"),
    ("USR890", "15:10:30", "15:41:15", 2, "SESS_890_001"),
]
SESSIONS_5_COUNT = 14
