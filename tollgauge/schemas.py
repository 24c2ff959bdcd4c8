"""Declared schemas of every landed source. Nothing is inferred."""

TRANSFER_LOG = "topics array<string>, data string, blockNumber string"

_OPTION = ("struct<amount:string,maxAmountRequired:string,asset:string,network:string,"
           "payTo:string,recipient:string>")

REGISTRY = f"""
    ordinal bigint, resource string, serviceName string, description string, tags array<string>,
    accepts array<{_OPTION}>,
    quality struct<l30DaysTotalCalls:bigint,l30DaysUniquePayers:bigint,lastCalledAt:string>,
    extensions struct<bazaar:struct<schema:string,info:struct<
        input:struct<method:string,body:string,queryParams:map<string,string>>,
        output:struct<example:string>>>>,
    metadata struct<provider:struct<name:string,category:string>>,
    lastUpdated string"""

CHALLENGE = f"""
    accepts array<{_OPTION}>, extensions struct<bazaar:string>,
    price struct<amount:string>, paymentInfo struct<network:string>,
    amount string, recipient string"""

TAPE_DAY = """
    date string, generated string, hours double,
    by_address map<string,struct<settlements:bigint,usdc:double,usdc_out:double,usdc_net:double,
        transfers_out:bigint,unique_payers:bigint,repeat_payers:bigint,top_payer_share:double,
        top5_payer_share:double,payer_hhi:double,first_block:bigint,last_block:bigint>>,
    by_wallet map<string,struct<settlements:bigint,usdc:double,unique_payers:bigint,host:string>>,
    _corrupt_record string"""

CAPTURE = """
    ts string, url string, method string, request_body string, returncode int,
    stdout string, stderr string"""

HIT = "ts bigint, tool string, subject string, client string, _corrupt_record string"

TOKEN_BALANCES = """
    signature string, account string, keys array<string>,
    pre array<struct<accountIndex:int,mint:string,owner:string,uiAmount:double>>,
    post array<struct<accountIndex:int,mint:string,owner:string,uiAmount:double>>,
    block_time bigint, failed boolean"""

#: the columns of one ledger for receipts of all kinds
LEDGER_COLUMNS = (
    "receipt_id string", "kind string", "ts string", "metric string", "url string", "host string", "quoted string",
    "charged string", "paid boolean", "free boolean", "tx string", "latency_ms bigint", "promised array<string>",
    "shape array<struct<path:string,type:string>>", "observed array<string>", "missing array<string>", "extra array<string>",
    "returned double", "truth double", "truth_source string", "dev_value double", "tol_value double", "unit string",
    "field string", "status string", "why string", "reverified boolean", "decided_by string", "raw_file string", "raw_id string")
