"""rulelake.operators"""
