"""The sample feeds, documents and configurations, and what they must give."""

CLIENT_A_CSV = """Emp_No,BasePay,Department,JoinDate
A001,350000,Sales,2020-04-01
A002,420000,Engineering,2019-07-15
A003,380000,HR,2021-01-10
A004,510000,Engineering,2018-03-20
A005,290000,Sales,2022-06-01
"""

CLIENT_B_CSV = """社員番号,基本給,部門,入社日
B001,¥300000,営業部,2020/04/01
B002,450000,開発部,2019/07/15
B003,非公開,人事部,2021/01/10
B004,380000,開発部,invalid_date
B005,320000,営業部,2022/06/01
"""

COMMON_MODEL = [
    ("A001", 350000, "Sales", "2020-04-01", "analyst,manager", "company_a"),
    ("A002", 420000, "Engineering", "2019-07-15", "analyst,manager", "company_a"),
    ("A003", 380000, "HR", "2021-01-10", "analyst,manager", "company_a"),
    ("A004", 510000, "Engineering", "2018-03-20", "analyst,manager", "company_a"),
    ("A005", 290000, "Sales", "2022-06-01", "analyst,manager", "company_a"),
    ("B001", 300000, "Sales", "2020-04-01", "analyst", "company_b"),
    ("B002", 450000, "Engineering", "2019-07-15", "analyst", "company_b"),
    ("B003", None, "HR", "2021-01-10", "analyst", "company_b"),
    ("B004", 380000, "Engineering", None, "analyst", "company_b"),
    ("B005", 320000, "Sales", "2022-06-01", "analyst", "company_b"),
]

COUNTS = [
    ("company_a", "Engineering", 2),
    ("company_a", "HR", 1),
    ("company_a", "Sales", 2),
    ("company_b", "Engineering", 2),
    ("company_b", "HR", 1),
    ("company_b", "Sales", 2),
]

ENGINEERING_GUIDE = """# エンジニアリングガイド

## 概要
本ドキュメントは開発チーム向けの内部ガイドです。

## 連絡先
不明点は support@example.com または 03-1234-5678 まで連絡してください。

## デプロイ手順
1. main ブランチにマージする
2. CI が通ったことを確認する
3. 本番へデプロイする
"""

SALES_POLICY = """# 営業ポリシー

## 行動指針
顧客第一で対応すること。

## 見積もりルール
値引きは20%までとする。例外は上長承認が必要。
"""

GUIDE_CHUNKS = [
    "エンジニアリングガイド > 概要\n本ドキュメントは開発チーム向けの内部ガイドです。",
    "エンジニアリングガイド > 連絡先\n不明点は [REDACTED_EMAIL] または [REDACTED_PHONE] まで連絡してください。",
    "エンジニアリングガイド > デプロイ手順\n1. main ブランチにマージする\n2. CI が通ったことを確認する\n3. 本番へデプロイする",
]

POLICY_CHUNKS = [
    "営業ポリシー > 行動指針\n顧客第一で対応すること。",
    "営業ポリシー > 見積もりルール\n値引きは20%までとする。例外は上長承認が必要。",
]

PARSING = """
source:
  path: "{path}"
  mode: {mode}

chunking:
  md:
    strategy: markdown_header
  pdf:
    strategy: paragraph
    max_chars: 1000
    overlap: 100
  pptx:
    strategy: paragraph
    max_chars: 800
    overlap: 80
  default:
    strategy: paragraph
    max_chars: 1000
    overlap: 100

permission_metadata:
  allowed_roles:
    - analyst
    - manager
  department: engineering
"""

EMPLOYEES = [
    ("E001", "Sato", "Sales", 350000, 28),
    ("E002", "Suzuki", "Engineering", 520000, 35),
    ("E003", "Takahashi", "Sales", 410000, 42),
    ("E004", "Tanaka", "Engineering", 480000, 31),
    ("E005", "Ito", "HR", 380000, 39),
    ("E006", "Watanabe", "Engineering", 610000, 45),
    ("E007", "Yamamoto", "Sales", 290000, 24),
    ("E008", "Nakamura", "HR", 430000, 50),
]

DEPARTMENTS = [
    ("Sales", "営業部", "Tokyo"),
    ("Engineering", "開発部", "Osaka"),
    ("HR", "人事部", "Tokyo"),
]
