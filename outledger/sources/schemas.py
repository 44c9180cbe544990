"""Declared schemas, so that no scan starts with an inference job."""

# Business tables as exported from the ERP; names follow the role of a table.
ERP = {
    "items": (
        "ItemCode string, ItemName string, validFor string, ItmsGrpCod int, DocEntry bigint, "
        "U_SubGrp1 string, U_SubGrp3 string, U_SubGrp4 string, U_SubGrp5 string, "
        "U_SubGrp6 string, U_SubGrp7 string, U_SubGrp11 string, U_SubGrp13 string, "
        "U_SubGrp17 string, U_Size string, SalPackMsr string, SalPackUn decimal(18,6), "
        "U_HSNCODE string, MinLevel decimal(18,6), MaxLevel decimal(18,6), "
        "U_taxrate decimal(18,6), U_taxrate1000 decimal(18,6)"
    ),
    "item_groups": "ItmsGrpCod int",
    "stock": "ItemCode string, WhsCode string, OnHand decimal(18,6)",
    "size_books": "DocEntry bigint, U_SubGroup3 string, U_ValidFrom timestamp_ntz, "
    "U_ValidTo timestamp_ntz",
    "size_book_lines": "DocEntry bigint, LineId int, U_SubGroup1 string, U_SubGroup4 string, "
    "U_SubGroup7 string",
    "size_book_states": "DocEntry bigint, U_Code string, U_Selected string",
    "size_book_prices": "DocEntry bigint, U_UniqID int, U_Size string, "
    "U_SelPrice decimal(18,6), U_MRP decimal(18,6)",
    "item_books": "DocEntry bigint, U_ItemCode string",
    "item_book_lines": "DocEntry bigint, LineId int, U_Brand string, U_Lock string, "
    "U_CatalgCode string",
    "item_book_prices": "DocEntry bigint, LineId int, U_RowId int, U_State string, "
    "U_SelPrice decimal(18,6), U_MRP decimal(18,6)",
    "schemes": "DocEntry bigint, DocNum bigint, Object string, Remark string, "
    "U_FrmDt timestamp_ntz, U_ToDt timestamp_ntz",
    "scheme_lines": "DocEntry bigint, LineId int, U_Discunt string, U_bran string, "
    "U_Stat string, U_Qual string, U_BillsQty decimal(18,6), U_OffersQty decimal(18,6)",
    "states": "Code string, Name string",
    "partners": (
        "CardCode string, CardName string, CardFName string, CardType string, validFor string, "
        "GroupCode string, Currency string, City string, DocEntry bigint, ShipToDef string, "
        "Phone1 string, Phone2 string, Cellular string, E_Mail string, UpdateTS string, "
        "U_AreaCode string, U_Grade string, U_GSTIN string, U_showcode string, "
        "U_SalPriceCode string, "
        + ", ".join(f"U_Dis{i} decimal(18,6)" for i in range(1, 12))
    ),
    "addresses": "CardCode string, LineNum int, AdresType string, Address string, "
    "Building string, Block string, Street string, City string, County string, "
    "State string, Country string, ZipCode string",
    "contacts": "CardCode string, CntctCode bigint, Name string, Position string, "
    "E_MailL string, Active string",
    "partner_groups": "GroupCode string, GroupName string",
    "journal": "TransId bigint, RefDate timestamp_ntz, memo string, TransType string",
    "journal_lines": "TransId bigint, ShortName string, Debit decimal(18,6), "
    "BalDueDeb decimal(18,6), Ref1 string, DueDate timestamp_ntz, TransType string",
    "invoices": "DocNum bigint, DocEntry bigint, DocDate timestamp_ntz, "
    "DocTotal decimal(18,6), CardCode string, U_Brand string, TransId bigint",
}

# State and log tables this package writes.
RECORD_STATUS = (
    "master_type string, record_key string, push_status string, last_pushed_at timestamp_ntz, "
    "error_message string, updated_at timestamp_ntz"
)
BOARD = (
    "sync_type string, display_name string, is_pushed boolean, last_status string, "
    "last_pushed_at timestamp_ntz, total_records bigint, success_count bigint, "
    "failed_count bigint, error_message string, updated_at timestamp_ntz, partial boolean"
)
PUNCH_LOG = (
    "ref_id string, employee_id string, punch_type string, punch_time timestamp_ntz, "
    "capture_time timestamp_ntz, push_status string"
)
JOB_LOG = (
    "job_key string, punch_type string, last_triggered_at timestamp_ntz, "
    "last_completed_at timestamp_ntz, last_status string, updated_at timestamp_ntz"
)

# Tables of the test data.
TEST = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
