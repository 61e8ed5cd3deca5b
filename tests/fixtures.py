"""Test inputs (see FIXTURES.md): the reference's two text files and literals, and our
own traces."""

HELLO_LINES = ["hello HPP", "hello DYL", "hello flink", "hello MWT", "hello world"]

# user.txt shape: name,age,address,email -- every age is 18 in the reference's sample;
# extra ages 17, 19, 30 and two bad lines are ours.
USER_LINES = [
    "张三,18,北京市朝阳区,zhangsan@example.com",
    "李四,18,上海市浦东新区,lisi@example.com",
    "王五,18,广州市天河区,wangwu@example.com",
    "kid,17,addr,kid@example.com",
    "ann,19,addr,ann@example.com",
    "bob,30,addr,bob@example.com",
]
BAD_USER_LINES = ["carl,abc,addr,c@example.com", "dora"]

SENSOR_LINES = ["s1,1,1", "s1,1,1", "s2,5,1", "s1,2,1", "s1,1,1"]
SENSOR_RUNNING_COUNT = [1, 2, 1, 1, 3]
SENSOR_RUNNING_AVG = [1.0, 1.0, 5.0, 4 / 3, 1.25]

JOIN_LEFT = [("a", 2), ("b", 3), ("c", 1), ("d", 2), ("e", 5), ("e", 5), ("f", 5)]
WINDOW_JOIN_RIGHT = [("a", 2, 11), ("b", 2, 22), ("c", 3, 33), ("d", 4, 11), ("e", 5, 11),
                     ("e", 6, 14), ("g", 7, 15)]
INTERVAL_JOIN_RIGHT = WINDOW_JOIN_RIGHT + [("f", 8, 15)]
# (k, left t, right t, v) with multiplicity
JOIN_EXPECTED = sorted([("a", 2, 2, 11), ("b", 3, 2, 22), ("c", 1, 3, 33), ("d", 2, 4, 11)]
                       + [("e", 5, 5, 11)] * 2 + [("e", 5, 6, 14)] * 2)
# tell the joins apart: interval-only and window-only pairs
INTERVAL_ONLY = (("h", 4), ("h", 5, 1))
WINDOW_ONLY = (("i", 0), ("i", 4, 1))

# Out-of-order trace: arrival order of ages (seconds), one key "a"; window 10 s,
# D = 3 s, L = 2 s.
OOO_ARRIVAL = [1, 9, 12, 5, 13, 4, 15, 27, 3, 40]
OOO_CLASS = ["on_time", "on_time", "on_time", "on_time", "on_time", "allowed_late",
             "on_time", "on_time", "late", "on_time"]

SESSION_ROWS = [("a", 0), ("a", 12), ("a", 25)]
