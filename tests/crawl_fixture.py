"""Writes a small crawl tree (FIXTURES.md sections 1 and 2) to a folder."""

import os

T = "\t"

LINES = {
    "080609": {
        "0.txt": [
            T.join(["aaa", "u1", "100", "Comedy", "60", "1000", "4.5", "10", "3", "r1", "r2"]),
            T.join(["bbb", "u2", "200", " UNA ", "300", "50", "5.0", "2", "1"]),   # 9 fields, spaced category
            "ccc",                                                                   # 1 field
            T.join(["ddd", "u3", "1", "Music", "5", "6", "7.0", "8"]),              # 8 fields
            T.join(["eee", "u4", "12.7", "Music", "5", "6", "1.0", "8", "9"]),      # bad integer
            T.join(["fff", "u5", "5", "News &amp; Politics", "61", "7", "3.0", "1", "0"]) + T + T,  # trailing tabs
        ],
        "1.txt": [
            T.join(["aaa", "u9", "999", "Comedy", "60", "1", "1.0", "1", "1"]),     # duplicate, later file
            T.join(["ggg", "u6", "3", "Sports", "3600", "0", "0.0", "0", "0", "x"]),
            T.join(["ggg", "u6", "4", "Sports", "3600", "0", "0.0", "0", "0"]),    # duplicate, same file
        ],
    },
    "080610": {
        "0.txt": [
            T.join(["bbb", "u2", "201", "UNA", "300", "60", "4.0", "2", "1"]),      # duplicate, later crawl
            T.join(["hhh", "u7", "7", "Comedy", "1200", "12345", "2.5", "9", "4", "a", "b", "c"]),
        ],
    },
    "080713": {   # log has no crawl date: folder skipped whole
        "0.txt": [T.join(["iii", "u8", "8", "Comedy", "1", "2", "3.0", "4", "5"])],
    },
    "080800": {   # no log file: folder skipped
        "0.txt": [T.join(["jjj", "u8", "8", "Comedy", "1", "2", "3.0", "4", "5"])],
    },
}

LOGS = {
    "080609": "BFS crawl\n\nvideo ID, uploader\n\nstart:  080610 1:29:13\nfinish: 080610 5:44:46\n",
    "080610": "BFS crawl\n\nstart:  080611 2:00:00\n",
    "080713": "BFS crawl\n\nstart:  ::\nfinish: 080713 23:13:22\n",
}


def write_tree(root):
    for folder, files in LINES.items():
        os.makedirs(os.path.join(root, folder), exist_ok=True)
        for name, lines in files.items():
            with open(os.path.join(root, folder, name), "w") as f:
                f.write("\n".join(lines) + "\n")
    for folder, text in LOGS.items():
        with open(os.path.join(root, folder, "log.txt"), "w") as f:
            f.write(text)
    return root
