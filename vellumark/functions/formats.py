"""Names and texts that documents must have exactly so."""

from __future__ import annotations

# Name space of payload documents and its version.
URN_START = "urn:eas-samples:en:xsd:"
SCHEMA_VERSION = "1.0"

# Name space of package descriptors, and the names of the two documents in a package.
DESCRIPTOR_SPACE = "urn:x-emc:ia:schema:sip:1.0"
PAYLOAD_NAME = "eas_pdi.xml"
DESCRIPTOR_NAME = "eas_sip.xml"

# Names an XSD document must not use for a field.
RESERVED_NAMES = ("language", "type", "schema", "element", "complexType", "sequence")

# JSON schema dialect, and the schema of an attachments column.
DRAFT = "http://json-schema.org/draft-07/schema#"
ATTACHMENTS_JSON = (
    '{"type":"object","properties":{"Attachment":{"type":"object","properties":{'
    '"Size":{"type":"number"},"EASFile":{"type":"string"},"FilePath":{"type":"string"},'
    '"checksum":{"type":"string","xsd_extension_attributes":{"encoding":"xs:string","algorithm":"xs:string"}},'
    '"mimetype":{"type":"string"}},'
    '"xsd_sequence":["mimetype","Size","EASFile","checksum","FilePath"]}},"xsd_sequence":["Attachment"]}'
)

# An XSD document around its fields.
XSD_HEAD = """\
<xs:schema elementFormDefault="qualified"
  targetNamespace="{urn}"
  version="{version}" xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="{root}">
    <xs:complexType>
      <xs:sequence maxOccurs="unbounded">
        <xs:element name="{child}" >
          <xs:complexType>
            <xs:sequence>
"""
XSD_TAIL = """\
            </xs:sequence>
          </xs:complexType>
        </xs:element>
      </xs:sequence>
    </xs:complexType>
  </xs:element>
</xs:schema>"""

# The optional attachments of a record.
XSD_ATTACHMENTS = """\
              <xs:element name="Attachments" minOccurs="0">
                <xs:complexType>
                  <xs:sequence maxOccurs="unbounded" minOccurs="0">
                    <xs:element name="Attachment">
                      <xs:complexType>
                        <xs:sequence>
                          <xs:element name="mimetype" type="xs:string" minOccurs="0"/>
                          <xs:element name="Size" type="xs:long" minOccurs="0"/>
                          <xs:element name="EASFile" type="xs:string" minOccurs="0"/>
                          <xs:element name="checksum" minOccurs="0">
                            <xs:complexType>
                              <xs:simpleContent>
                                <xs:extension base="xs:string">
                                  <xs:attribute name="algorithm" type="xs:string" use="required"/>
                                  <xs:attribute name="encoding" type="xs:string" use="required"/>
                                </xs:extension>
                              </xs:simpleContent>
                            </xs:complexType>
                          </xs:element>
                          <xs:element name="FilePath" type="xs:string" minOccurs="0"/>
                        </xs:sequence>
                      </xs:complexType>
                    </xs:element>
                  </xs:sequence>
                </xs:complexType>
              </xs:element>
"""
