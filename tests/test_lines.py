"""Amounts of claim lines, listed once per line for all of their columns."""

from conftest import rows

from clinflat.functions import codes
from clinflat.plans.tables import TABLES
from clinflat.sources.schemas import resource_schema

VIEW = TABLES["explanation_of_benefit_item"].only(["eob_id", "sequence", "submitted_amount", "allowed_amount", "paid_amount"])


def entry(codings, amount):
    return {"category": None if codings is None else {"coding": codings}, "amount": amount}


def coded(code, amount):
    return entry([{"code": code}], {"value": amount})


def lines(ndjson, *adjudications):
    item = [{"sequence": k + 1, "adjudication": a} for k, a in enumerate(adjudications)]
    return VIEW.apply(ndjson([{"resourceType": "ExplanationOfBenefit", "id": "e", "item": item}], resource_schema("ExplanationOfBenefit")))


def test_amounts_of_odd_entries(ndjson):
    sent, allowed, paid = codes.LINE_SUBMITTED, codes.LINE_ALLOWED, codes.LINE_PAID
    found = rows(
        lines(
            ndjson,
            [coded(paid, 3.5), coded(sent, 1.5), coded(allowed, 2.5)],
            None,
            [entry(None, {"value": 9}), entry([], {"value": 9}), entry([None], {"value": 9}), coded(paid, 4)],
            [entry([{"code": paid}, {"code": sent}], {"value": 9}), entry([None, {"code": sent}], {"value": 5})],
            [entry([{"code": paid}], None), entry([{"code": paid}], {}), coded(paid, 6), coded(paid, 7)],
            [entry([{"display": "no code"}], {"value": 9}), coded("other", 8), coded(allowed, 0)],
        )
    )
    amounts = {r["sequence"]: (r["submitted_amount"], r["allowed_amount"], r["paid_amount"]) for r in found}
    assert amounts == {
        1: (1.5, 2.5, 3.5),
        2: (None, None, None),
        3: (None, None, 4),
        4: (5, None, None),
        5: (None, None, 6),
        6: (None, 0, None),
    }


def test_amounts_are_listed_once(ndjson):
    plan = lines(ndjson, [coded(codes.LINE_PAID, 1)])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(".adjudication.amount.value") == 1
