"""Composed feed plans (M15, M16) and feed projections."""

from .cw import CW_COLUMNS, MawbContext, cw_feed
from .feeds import cw_hawb_feed, cw_mawb_feed, wt_hawb_feed, wt_mawb_feed
from .wt import WT_COLUMNS, airwaybill_detail, shipment_weights, wt_feed, wt_rows

__all__ = ["CW_COLUMNS", "MawbContext", "WT_COLUMNS", "airwaybill_detail", "cw_feed",
           "cw_hawb_feed", "cw_mawb_feed", "shipment_weights", "wt_feed", "wt_hawb_feed",
           "wt_mawb_feed", "wt_rows"]
